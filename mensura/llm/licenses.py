"""Licence recognition by sentence rules.

A text is cut into sentences; each is normalised (case, spelling, comment marks,
quotes, version forms, articles, ways to say "licensed under") and looked up
among known licence sentences.  A sentence may be wrapped over lines, each with
its own comment mark; it ends at ``.!?;``, blank lines and list marks.  A line
that is a known sentence by itself is one.  The identifiers found, in order, are matched
against ordered rules: at each place the first rule whose sequence follows
names a licence, and the next place is after it.  Other sentences may stand
between two identifiers of a rule, up to ``GAP`` of them.

Sentences that name licences ("licensed under ...", SPDX lines) are read by
their parts: known names joined by "or", "and" or "with", each perhaps "or
later".  Such a choice is one identifier and one licence expression.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table
from .words import slices

GAP = 3

# Names of licences, normalised.
NAMES = {
    "Apache-2.0": ("apache license v2", "apache 2", "apache v2", "apache license 2"),
    "MIT": ("mit license", "mit", "expat license"),
    "GPL-2.0": ("gnu general public license v2", "gnu gpl v2", "gpl v2", "gpl 2", "gplv2"),
    "GPL-3.0": ("gnu general public license v3", "gnu gpl v3", "gpl v3", "gpl 3", "gplv3"),
    "LGPL-2.1": ("gnu lesser general public license v2.1", "gnu lgpl v2.1", "lgpl v2.1", "lgplv2.1"),
    "LGPL-3.0": ("gnu lesser general public license v3", "gnu lgpl v3", "lgpl v3", "lgplv3"),
    "AGPL-3.0": ("gnu affero general public license v3", "gnu agpl v3", "agpl v3", "agplv3"),
    "BSD-2-Clause": ("bsd 2-clause license", "2-clause bsd license", "simplified bsd license", "bsd-2-clause"),
    "BSD-3-Clause": ("bsd 3-clause license", "3-clause bsd license", "new bsd license", "bsd license", "bsd-3-clause"),
    "MPL-2.0": ("mozilla public license v2", "mpl v2", "mpl 2"),
    "EPL-2.0": ("eclipse public license v2", "epl v2", "epl 2"),
    "EPL-1.0": ("eclipse public license v1", "epl v1"),
    "BSL-1.0": ("boost software license v1", "boost software license", "boost license v1"),
    "Zlib": ("zlib license", "zlib"),
    "0BSD": ("zero-clause bsd license", "0bsd", "bsd zero clause license"),
    "MIT-0": ("mit no attribution license", "mit-0"),
    "WTFPL": ("wtfpl", "do what the fuck you want to public license"),
    "OFL-1.1": ("sil open font license v1.1", "sil open font license"),
    "Artistic-2.0": ("artistic license v2", "artistic license 2"),
    "PostgreSQL": ("postgresql license",),
    "Python-2.0": ("python software foundation license", "psf license"),
    "EUPL-1.2": ("european union public license v1.2", "eupl v1.2"),
    "MS-PL": ("microsoft public license", "ms-pl"),
    "CDDL-1.0": ("common development and distribution license v1", "cddl v1"),
    "ISC": ("isc license",),
    "Unlicense": ("unlicense",),
    "CC0-1.0": ("cc0", "cc0 1", "creative commons zero v1"),
    "CC-BY-4.0": ("cc by 4", "cc-by 4", "creative commons attribution 4 international license", "creative commons attribution license"),
    "CC-BY-SA-4.0": ("cc by-sa 4", "cc-by-sa 4", "creative commons attribution-sharealike 4 international license"),
    "CC-BY-NC-4.0": ("cc by-nc 4", "cc-by-nc 4", "creative commons attribution-noncommercial 4 international license"),
    "CC-BY-ND-4.0": ("cc by-nd 4", "cc-by-nd 4", "creative commons attribution-noderivatives 4 international license"),
    "CC-BY-NC-SA-4.0": ("cc by-nc-sa 4", "cc-by-nc-sa 4", "creative commons attribution-noncommercial-sharealike 4 international license"),
}

# Further identifiers of SPDX lines, and exceptions.
SPDX = ("AFL-3.0", "Apache-1.1", "BSD-4-Clause", "BlueOak-1.0.0", "CC-BY-3.0", "CC-BY-SA-3.0", "ECL-2.0", "GPL-1.0", "LGPL-2.0", "MPL-1.1", "NCSA", "OSL-3.0", "UPL-1.0", "Vim",
        "W3C", "X11", "ZPL-2.1")
EXCEPTIONS = ("Classpath-exception-2.0", "LLVM-exception", "GCC-exception-3.1", "Linux-syscall-note", "Autoconf-exception-3.0", "OpenSSL-exception")

# Sentences of licence texts and notices, as they read.
SENTENCES = {
    "all-rights": ("All rights reserved",),
    "mit-grant": ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",),
    "mit-notice": ("The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",),
    "as-is": ("THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT",),
    "isc-grant": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",),
    "bsd-grant": ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",),
    "bsd-source": ("Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",),
    "bsd-binary": ("Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",),
    "bsd-endorse": ("Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",),
    "gpl-free": ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",),
    "gpl2-free": ("This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version",),
    "lgpl21-free": ("This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version",),
    "lgpl3-free": ("This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
                   "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    "agpl-free": ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",),
    "mpl-form": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",),
    "bsd-style": ("Use of this source code is governed by a BSD-style license that can be found in the LICENSE file",
                  "Use of this source code is governed by a BSD-style license", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file in the root of the source tree"),
    "mit-style": ("Use of this source code is governed by an MIT-style license that can be found in the LICENSE file",
                  "Use of this source code is governed by an MIT-style license that can be found in the LICENSE file or at https://opensource.org/licenses/MIT"),
    "zlib-grant": ("Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",),
    "boost-grant": ("Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:",),
    "apache-comply": ("you may not use this file except in compliance with the License",),
    "public-domain": ("This is free and unencumbered software released into the public domain",),
}

#: Ordered rules: the first whose sequence follows wins.
RULES = (
    ("MIT", ("mit-grant", "mit-notice", "as-is")),
    ("MIT", ("mit-grant", "mit-notice")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("GPL-3.0-or-later", ("gpl-free",)),
    ("GPL-2.0-or-later", ("gpl2-free",)),
    ("LGPL-2.1-or-later", ("lgpl21-free",)),
    ("LGPL-3.0-or-later", ("lgpl3-free",)),
    ("AGPL-3.0-or-later", ("agpl-free",)),
    ("MPL-2.0", ("mpl-form",)),
    ("LicenseRef-BSD-style", ("bsd-style",)),
    ("LicenseRef-MIT-style", ("mit-style",)),
    ("Zlib", ("zlib-grant",)),
    ("BSL-1.0", ("boost-grant",)),
    ("ISC", ("isc-grant",)),
    ("Unlicense", ("public-domain",)),
    *((name, (f"ref:{name}", "apache-comply")) for name in ("Apache-2.0",)),
    *((name, (f"spdx:{name}",)) for name in NAMES),
    *((name, (f"ref:{name}",)) for name in NAMES),
    ("LicenseRef-all-rights-reserved", ("all-rights",)),
)

#: Every known sentence has one of these in it; texts without them are passed over.
CUES = ("license", "licence", "mozilla", "rights", "permission", "redistribut", "endorse", "warranty", "compliance", "public",
        "spdx", "released", "distributed", "available", "under")

SENTENCE = re.compile(r"(?:[^\n.!?;]|[.!?;](?=[^\s]))+")
LETTER = re.compile(r"[^\W\d_]")
# Comment marks and bullets at the start of a line, comment and box marks at
# its end, and list marks like ``(a)`` or ``2)``; ``1.`` ends as a sentence.
LEAD = re.compile(r"^[ \t]*(?:(?:[#*/;%!|>'\"•·=~+\-]+|<!--|\.\.(?=\s)|\.\\\"|(?:REM|rem|dnl)(?=[ \t]))[ \t]*)+", re.M)
TRAIL = re.compile(r"(?<=[ \t])(?:[-*#|/%+]+|-->)[ \t\r]*$", re.M)
MARK = re.compile(r"^[ \t]*\(?(?:[0-9]{1,2}|[a-z]|[ivx]{2,4})\)(?=[ \t])", re.M)
_UNDER = re.compile(r"^(?:(?:this|the) \S+(?: \S+)? is )?(dual[- ])?(?:licensed|released|distributed|available|made available|provided) (?:to you )?under (?:terms of )?")
_LICENSES = re.compile(r"^the (?:\S+ ){1,3}licenses this file to you under ")
#: The point of "v. 2.0" ends no sentence.
ABBREVIATED = re.compile(r"\b[vV]\.(?=[ \t]*[0-9])")
_ENDED = re.compile(r"[.!?][\"'”’)\]]+\s*$")


def normalised(sentence: str) -> str:
    s = sentence.lower().replace("licence", "license")
    s = re.sub(r"[\"'`“”‘’(),:;*#/|<>=_]+", " ", s)
    s = re.sub(r"\b(?:version|v\.?)\s*(\d+(?:\.\d+)*)", r"v\1", s)
    s = re.sub(r"(\d)\.0\b", r"\1", s)
    s = re.sub(r"\s+", " ", s).strip(" .-!?")
    s = re.sub(r"\bunder the\b", "under", s)
    return _UNDER.sub(lambda m: ("dual " if m[1] else "") + "licensed under ", _LICENSES.sub("licensed under ", re.sub(r"\bterms of the\b", "terms of", s)))


def _known() -> dict[str, str]:
    out = {normalised(t): i for i, forms in SENTENCES.items() for t in forms}
    for name, forms in NAMES.items():
        out[f"spdx-license-identifier {normalised(name)}"] = f"spdx:{name}"
        for form in forms:
            for end in ("", " license", " the license"):  # the last is (the "License")
                out[f"licensed under {form}{end}"] = f"ref:{name}"
    return out


KNOWN = _known()
_FORMS = {form: name for name, forms in NAMES.items() for form in (*forms, normalised(name))}
_IDS = {normalised(name): name for name in (*NAMES, *SPDX)}
_WITH = {normalised(name): name for name in EXCEPTIONS}
_LATER = re.compile(r"(?:-or-later|\+| or later| or any later version| or at your option any later version)$")
_SEE = re.compile(r" (?:license )?(?:see|found in|in) (?:the )?(?:accompanying |attached )?(?:file )?(?:license|copying)\S*(?: file)?(?: (?:for|in) .*)?$")
SPDX_LINE, LICENSED, DUAL = "spdx-license-identifier ", "licensed under ", "dual licensed under "


def _named(s: str) -> str | None:
    """The licence that a part of a sentence names."""
    bare = _LATER.sub("", s)
    later = "-or-later" if bare != s else ""
    bare = re.sub(r"^(?:the|a|an) ", "", bare)
    for form in (bare, bare.removesuffix(" the license"), re.sub(r" licenses?$", "", bare), re.sub(r" licenses$", " license", bare), bare + " license"):
        if form in _FORMS:
            return _FORMS[form] + later
    return None


def _choice(s: str, dual: bool) -> str | None:
    """Licence expression of what follows "licensed under"."""
    s = _SEE.sub("", s)
    s = re.sub(r"^(?:either of|either|both|any of|one of) (?:the )?", "", s)
    if not s.endswith("any later version"):
        s = re.sub(r" at your option$", "", s)
    whole = _named(s)
    if whole or len(s) > MOST:
        return whole
    parts = re.split(r" (or|and) (?!later|any later|at your option any)", s)
    names = [_named(p) for p in parts[::2]]
    if len(names) < 2 or None in names:
        return None
    return (" OR " if dual or "or" in parts[1::2] else " AND ").join(names)


def _spdx(s: str) -> str | None:
    """Licence expression of an SPDX line, without its parentheses."""
    out, words = [], s.split(" ")
    for i, w in enumerate(words):
        if i % 2:
            if w not in ("or", "and", "with"):
                return None
            out.append(w.upper())
        elif i and words[i - 1] == "with":
            out.append(_WITH.get(w, w))
        else:
            m = re.search(r"(-or-later|-only|\+)$", w)
            name = _IDS.get(w) or m and _IDS.get(w[:m.start()])
            if not name:
                return None
            out.append(name if w in _IDS else name + ("-only" if m[1] == "-only" else "-or-later"))
    return " ".join(out) if len(words) % 2 else None


def identify(s: str) -> str | None:
    """Identifier of a normalised sentence: a known one, or ``choice:`` and the
    expression that it states."""
    if s in KNOWN:
        return KNOWN[s]
    for start, read in ((SPDX_LINE, _spdx), (DUAL, lambda x: _choice(x, True)), (LICENSED, lambda x: _choice(x, False))):
        if s.startswith(start):
            found = read(s[len(start):])
            return found and f"choice:{found}"
    return None


#: Words before "licensed under", and the most characters that are looked up together.
BEFORE = frozenset("this the dual licensed released distributed available made provided".split())
_SORTED = sorted(KNOWN)
MOST = 2 * max(map(len, KNOWN))


def _begins(so_far: str) -> bool:
    """May a normalised text be the beginning of a known sentence?  What its
    last words become depends on the words that follow."""
    w = so_far.split(" ")
    if w[0] in BEFORE and len(w) <= 24:
        return True
    head = " ".join(w[:-3])
    k = bisect_left(_SORTED, head)
    return k < len(_SORTED) and _SORTED[k].startswith(head)


def _blank(m: re.Match) -> str:
    return " " * len(m[0])


def sentences(text: str) -> list[tuple[int, int, str | None, int]]:
    """(start, end, identifier or None, number of the sentence) of each known
    sentence and of each other line or part of one that has a letter.

    Parts that are lines of one sentence, or that a semicolon divides, are
    looked up together, and the longest known run counts.  The number is the
    same for the lines of an unknown sentence.
    """
    bare = ABBREVIATED.sub(lambda m: m[0][:-1] + " ", TRAIL.sub(_blank, LEAD.sub(_blank, text)))
    marks = [m.end() for m in MARK.finditer(bare)]
    bare = MARK.sub(_blank, bare)
    parts = [(m.start(), m.end()) for m in SENTENCE.finditer(bare) if not m[0].isspace()]
    joins = []  # how a part goes on in the next: 2 on the next line, 1 after a semicolon, 0 not at all
    for (s, e), (t, u) in pairwise(parts):
        between, k = bare[e:t], bisect_right(marks, t)
        new = between.count("\n") > 1 or not {*".!?"}.isdisjoint(between) or k < len(marks) and marks[k] <= u or _ENDED.search(bare[s:e][-9:])
        joins.append(0 if new else 1 if ";" in between else 2)
    joins.append(0)
    out, i, number, same = [], 0, -1, False
    while i < len(parts):
        s, e = parts[i]
        if not LETTER.search(bare, s, e):
            same = same and joins[i] == 2
            i += 1
            continue
        so_far = normalised(bare[s:e])
        known, end, j, size = identify(so_far), i, i, 0
        while joins[j] and size <= MOST and _begins(so_far):
            j += 1
            size += len("".join(bare[slice(*parts[j])].split()))
            so_far = normalised(bare[s:parts[j][1]])
            longer = identify(so_far)
            if longer:
                known, end = longer, j
        number += not same or known is not None
        out.append((s, parts[end][1], known, number))
        same = joins[end] == 2 and known is None
        i = end + 1
    return out


def recognise(text: str) -> tuple[list[str], list[tuple[str, int, int]]]:
    """(identifiers in order, findings as (licence, start, end))."""
    found = [(number, s, e, i) for s, e, i, number in sentences(text) if i]
    ids, out, at = [x[3] for x in found], [], 0
    while at < len(found):
        if ids[at].startswith("choice:"):
            out.append((ids[at].removeprefix("choice:"), found[at][1], found[at][2]))
            at += 1
            continue
        for name, sequence in RULES:
            n = len(sequence)
            if tuple(ids[at:at + n]) == sequence and all(found[at + j + 1][0] - found[at + j][0] <= GAP + 1 for j in range(n - 1)):
                out.append((name, found[at][1], found[at + n - 1][2]))
                at += n
                break
        else:
            at += 1
    return ids, out


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_sentences (known ones), sentence_ids
    (in order), n_licenses, licenses (distinct, sorted), findings
    (``licence:start:end`` in code points, end exclusive).

    Lists are comma-joined strings.  A null or empty text has none; repeated
    rows are each scanned; other columns are not read.
    """
    names = ["doc_id", "n_sentences", "sentence_ids", "n_licenses", "licenses", "findings"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cue = "(?i)" + "|".join(CUES)
        for rb in batches:
            for lo, hi in slices(rb.column(1)):
                texts = rb.column(1).slice(lo, hi - lo)
                rows = np.flatnonzero(pc.match_substring_regex(texts, cue).fill_null(False).to_numpy(zero_copy_only=False))
                got = {i: recognise(t) for i, t in zip(rows.tolist(), texts.take(pa.array(rows)).to_pylist())}
                every = [got.get(i, ([], [])) for i in range(hi - lo)]
                licenses = [sorted({f[0] for f in x[1]}) for x in every]
                yield pa.RecordBatch.from_arrays([
                    rb.column(0).slice(lo, hi - lo), pa.array([len(x[0]) for x in every], pa.int64()), pa.array([",".join(x[0]) for x in every]),
                    pa.array([len(x) for x in licenses], pa.int64()), pa.array([",".join(x) for x in licenses]),
                    pa.array([",".join(f"{n}:{s}:{e}" for n, s, e in x[1]) for x in every])], names)

    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return own.mapInArrow(run, f"doc_id {own.schema['doc_id'].dataType.simpleString()}, n_sentences long, sentence_ids string, n_licenses long, licenses string, findings string")


def op9_licenses(spark, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
