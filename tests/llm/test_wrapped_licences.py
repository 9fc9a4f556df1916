"""Licence texts and source headers as they are written: wrapped, commented."""

import pytest

from mensura.llm import licenses

MIT = '''The MIT License (MIT)

Copyright (c) 2020 A. Body

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM.'''
BSD = '''Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

{} Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

{} Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

{} Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.'''
ISC = '''Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.'''
GPL3 = '''This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.'''
GPL2 = '''This program is free software; you can redistribute it and/or
modify it under the terms of the GNU General Public License
as published by the Free Software Foundation; either version 2
of the License, or (at your option) any later version.'''
APACHE = '''Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0'''
ASF = '''Licensed to the Apache Software Foundation (ASF) under one or more
contributor license agreements.  The ASF licenses this file to You under the
Apache License, Version 2.0 (the "License"); you may not use this file except
in compliance with the License.'''
TEXTS = [(MIT, "MIT"), (BSD.format("1.", "2.", "3."), "BSD-3-Clause"), (BSD.format("(a)", "(b)", "(c)"), "BSD-3-Clause"), (BSD.format("*", "*", "*"), "BSD-3-Clause"),
         (BSD.format("1)", "2)", "3)").split("\n\n3)")[0], "BSD-2-Clause"), (ISC, "ISC"), (GPL3, "GPL-3.0-or-later"), (GPL2, "GPL-2.0-or-later"), (APACHE, "Apache-2.0"), (ASF, "Apache-2.0")]


def written(text):
    """As it stands, in comments of several languages, in a box, with CR LF, on one line."""
    lines = text.split("\n")
    yield text
    for mark in ("# ", "// ", ";; ", "-- ", "% ", "! ", "dnl ", "REM ", "> "):
        yield "\n".join((mark + x).rstrip() for x in lines)
    yield "/*\n" + "\n".join((" * " + x).rstrip() for x in lines) + "\n */"
    yield "\n".join(["/" + "*" * 90] + [f"* {x:<86} *" for x in lines] + ["*" * 90 + "/"])
    yield "<!--\n" + "\r\n".join(lines) + "\n-->"


@pytest.mark.parametrize("text,name", TEXTS)
def test_wrapped_texts(text, name):
    for t in written(text):
        ids, found = licenses.recognise(t)
        assert [f[0] for f in found] == [name], t
        (_, s, e), = found
        first, last = {"MIT": ("Permission", "NONINFRINGEMENT"), "Apache-2.0": ("", "the License")}.get(name, ("", ""))
        assert first in t[s:e] and t[s:e].endswith(last)
    # Code points, not bytes, and nothing before or after the sentences.
    (_, s, e), = licenses.recognise("é 中 😀.\n\n" + text)[1]
    (_, s0, e0), = licenses.recognise(text)[1]
    assert (s - 8, e - 8) == (s0, e0)


def test_where_sentences_end():
    names = lambda t: [f[0] for f in licenses.recognise(t)[1]]
    assert names("Licensed under the MIT License\nCopyright 2020 A. Body") == ["MIT"]
    assert names("Foo 1.2\nSPDX-License-Identifier: ISC\nmore words") == ["ISC"]
    assert names("This work is licensed under the GNU General Public License, version\n3. It is new.") == ["GPL-3.0"]
    assert names("All rights\nreserved") == ["LicenseRef-all-rights-reserved"]
    assert names("All rights\n\nreserved") == names("All rights. reserved") == names("All rights\na) reserved") == []
    # Four unknown sentences between are too many, one over four lines is not.
    grant, notice = (licenses.SENTENCES[k][0] for k in ("mit-grant", "mit-notice"))
    assert names(f"{grant}\n\nsome\nwords\non\nfour\nlines.\n\n{notice}") == ["MIT"]
    assert names(f"{grant}\n\nOne. Two. Three. Four.\n\n{notice}") == []


def test_long_runs_of_short_lines_take_no_longer():
    import time

    t = time.process_time()
    for line in ("the\n", "this program is\n", "licensed under\n", "permission is\n", "(\n", "redistribution and\n(\n"):
        licenses.recognise("licensed\n" + line * 20_000)
    assert time.process_time() - t < 60


def test_passed_over_texts_hold_nothing(spark, frame):
    texts = [t for text, _ in TEXTS for t in written(text)] + ["“Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:”", "nothing", "", None]
    got = {r.doc_id: (r.sentence_ids, r.findings) for r in licenses.scan(frame(list(enumerate(texts)))).collect()}
    for i, t in enumerate(texts):
        ids, found = licenses.recognise(t or "")
        assert got[i] == (",".join(ids), ",".join(f"{n}:{s}:{e}" for n, s, e in found))
    assert got[len(texts) - 4][0] == "bsd-grant"
