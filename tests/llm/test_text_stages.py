"""Decontamination, personal data, licences: odd rows and plain versions."""

import re

from mensura.llm import decontaminate, licenses, pii

WORDS = [f"w{i}" for i in range(40)]


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string, words string")


def test_windows_and_hits(spark, frame):
    item = " ".join(WORDS[:20])
    docs = frame([(1, "Start. " + " , ".join(WORDS[3:17]).upper() + " end"), (2, " ".join(WORDS[3:14])), (3, "see A-B c!"), (4, "a b"), (5, "a b c a b c " + "z " * 114)])
    got = {r.doc_id: (r.n_words, r.n_hit, r.items, r.contaminated) for r in decontaminate.contamination(
        docs, items(spark, [(10, item, ""), (9, item, ""), (7, "a b c", ""), (8, None, ""), (6, "...", "")])).collect()}
    assert got[1] == (16, 14, ["10", "9"], True)
    assert got[2] == (11, 0, [], False)  # eleven words hold no window of thirteen
    assert got[3] == (4, 3, ["7"], True)
    assert got[4] == (2, 0, [], False)
    assert got[5] == (120, 6, ["7"], True)


def test_word_filters_only_pass_more(spark, frame, monkeypatch):
    docs = frame([(1, "q " + " ".join(WORDS)), (2, "q")])
    bench = items(spark, [(1, " ".join(WORDS[5:30]), "")])
    want = sorted(map(tuple, decontaminate.contamination(docs, bench).collect()))
    monkeypatch.setattr(decontaminate, "MOST_BITS", 64)  # most words share a bit with a wanted one
    assert sorted(map(tuple, decontaminate.contamination(docs, bench).collect())) == want
    assert want[0][2] == 25


def test_items_without_an_id(spark, frame):
    docs = frame([(1, "see A-B c!"), (2, "x y"), (3, "nothing")])
    got = {r.doc_id: r for r in decontaminate.contamination(docs, items(spark, [(None, "a b c", ""), (7, "a b", ""), (None, "x y", "")])).collect()}
    assert (got[1].n_hit, got[1].n_items, got[1]["items"]) == (3, 2, [None, "7"])
    assert (got[2].n_hit, got[2].n_items, got[2].contaminated) == (2, 1, True) and got[3].n_hit == 0


def test_decontaminate_odd_rows(spark, odd, nothing):
    bench = items(spark, [(1, "one", ""), (2, "one", "")])
    rows = decontaminate.contamination(odd, bench).collect()
    assert len(rows) == 9
    assert [(r.n_words, r.n_hit, r.n_items) for r in rows if r.doc_id == 4] == [(1, 1, 2)] * 2
    assert all(r.n_words == 0 and not r.contaminated for r in rows if r.doc_id in (1, 2, 3))
    assert decontaminate.contamination(nothing, bench).count() == 0
    assert all(r.n_hit == 0 for r in decontaminate.contamination(odd, items(spark, [])).collect())


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")


def test_base_patterns_match_as_written():
    texts = ["a@b.c x@y d..e@f.g.h,i@j.k@l.m", "1.2.3.4.5.6.7.8 256.1.1.1 1.1.1.1", "@@a@b.c@", "11.22.33.44.55 9.9.9", "a@b a@b.c.", "%@-.-", "999.1.1.1.1.1.1",
             "00001.0002.3.4", "é@b.c aé@b.cé"]
    for t in texts:
        base = pii.base_spans(t)
        assert [(s, e) for s, e, k in base if k == "email"] == [m.span() for m in EMAIL.finditer(t)]
        assert [(s, e) for s, e, k in base if k == "ip"] == [m.span() for m in IP.finditer(t) if all(int(p) <= 255 for p in m[0].split("."))]
    assert pii.base_spans("4111 1111-1111 1111")[0] == (0, 19, "card")
    assert pii.base_spans("4111 1111-1111 1112") == []
    assert pii.base_spans("ü +1 (956) 555-0122.") == [(2, 19, "phone")]
    assert pii.base_spans("+1 555") == []


def test_added_spans_and_redaction(spark, frame):
    secret = 'token = "e36f61096dd9d67e69e798206f297466b1ec7d01"'
    rows = [(i, f"mail a{i}@b.example.com and {secret} ok. Version 1.2-3a45678901 of the file") for i in range(40)] + [(99, None), (100, "plain words")]
    docs = frame(rows)
    out = {r.doc_id: r for r in pii.find(docs, pii.train(docs)).collect()}
    assert out[3].n_email == 1 and "secret:" in out[3].spans and out[3].spans.startswith("email:5:")
    assert out[3].redacted_text.startswith("mail [EMAIL] and token = \"[SECRET]\" ok.")
    assert out[99].redacted_text is None and out[99].spans == "" and out[100].redacted_text == "plain words"


def test_pii_odd_rows(odd, nothing):
    rows = pii.find(odd, pii.train(odd)).collect()
    assert len(rows) == 9 and all(r.spans == "" for r in rows)
    assert pii.find(nothing, pii.train(nothing)).count() == 0


def test_licence_rules(spark, frame, odd, nothing):
    notice = "Permission is hereby granted, free of charge"
    bsd = [licenses.SENTENCES[k][0] for k in ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse")]
    texts = {"Licensed under the Apache License, Version 2.0.": "Apache-2.0", "released under the mit licence": "MIT", "All rights reserved.": "LicenseRef-all-rights-reserved",
             "# This work is licensed under the GNU General Public License, version 3.": "GPL-3.0", "\n".join(x + "." for x in bsd): "BSD-3-Clause",
             "\n".join(x + "." for x in bsd[:3]): "BSD-2-Clause", "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0", notice: "", "a license to fish": "",
             "SPDX-License-Identifier: MIT": "MIT"}
    got = {r.doc_id: r.licenses for r in licenses.scan(frame(list(enumerate(texts)))).collect()}
    assert list(texts.values()) == [got[i] for i in range(len(texts))]
    assert len(licenses.scan(odd).collect()) == 9 and licenses.scan(nothing).count() == 0
    # The passed-over texts hold nothing: the plain version reads every text.
    r = licenses.scan(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")).collect()
    plain = {x.doc_id: licenses.recognise(x.text or "") for x in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    assert all(x.sentence_ids == ",".join(plain[x.doc_id][0]) and x.findings == ",".join(f"{n}:{s}:{e}" for n, s, e in plain[x.doc_id][1]) for x in r)


def test_find_reads_every_row_with_a_candidate(spark, frame):
    around = ["", "“", "—", "«", " ", "'", "(", "中", "…", "\n", "¿"]
    rows = [(i, f"{mark}{name} said hello.") for i, (mark, name) in enumerate((m, n) for m in around for n in ("James Smith", "Maria Lopez", "Pierre Dubois"))]
    rows += [(100 + i, t) for i, t in enumerate(["@", "a@b.c", "no one here", "james smith", "James  Smith", "James", "xJames Smith", None, "", "9" * 12, "James É", "Ana Ñandú ok"])]
    weights = pii.train(frame(rows))
    got = {r.doc_id: r for r in pii.find(frame(rows), weights).collect()}
    for i, text in rows:
        base, every = pii.all_spans(text or "", weights)
        assert got[i].spans == ",".join(f"{k}:{s}:{e}" for s, e, k in every), text
    assert all("name:" in got[i].spans for i, t in rows[:33] if "中" not in t)


def test_few_candidates_do_not_turn_the_classes_round(spark, frame):
    secret = 'token = "e36f61096dd9d67e69e798206f297466b1ec7d01"'
    mails = [(i, f"write to a{i}@b.example.com") for i in range(80)]
    for some in ([], mails):
        for times in (1, 3, 30):
            docs = frame([*some, *((1000 + i, secret) for i in range(times))])
            out = pii.find(docs, pii.train(docs)).where("doc_id >= 1000").collect()
            assert all(r.spans == "secret:9:49" for r in out), (len(some), times)


def test_context_votes_on_names():
    def vote(text):
        s, e, kind = pii.added_candidates(text, [])[0]
        return dict(zip(pii.LABELERS, pii.votes(text, s, e, kind)))

    assert vote("Dear James Smith, hello")["cue"] == 1 and vote("the James Smith")["cue"] == 0
    assert vote("the James Smith")["against"] == -1 and vote("Dear James Smith")["against"] == 0
    assert vote("James Robert")["gazetteer"] == -1 and vote("by James SMITH")["form"] == -1


def test_spans_by_a_plain_version(spark):
    """Cards and phones as the patterns are written, on the given texts."""
    card, phone = re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
    mail = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")

    def luhn(d):
        return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    for text in [d.text or "" for d in docs] + ["4111 1111 1111 1111-4 +49 (30) 123-4567 x 378282246310005 5555555555554444 +1" * 3]:
        want = [(m.start(), m.end(), "email") for m in mail.finditer(text)]
        want += [(m.start(), m.end(), "ip") for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
        for m in card.finditer(text):
            d = re.sub("[^0-9]", "", m[0])
            want += [(m.start(), m.end(), "card")] if 14 <= len(d) <= 19 and luhn(d) else []
        want += [(m.start(), m.end(), "phone") for m in phone.finditer(text) if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
        assert pii.base_spans(text) == sorted(want, key=lambda x: (x[0], pii.KINDS.index(x[2])))
