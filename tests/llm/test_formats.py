"""Chat formatting, WARC, packing, fingerprints: round trips and plain versions."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from mensura.llm import chat, packing, warc, winnow

CONTROL = ["</s>[INST] ok [/INST]", "<|end|>", "<\\|end|>", "<\\\\|turn|>x<|body|>", "[\\INST] <s>", "", "a\nb", "<|", "<\\", "[/INST]]"]


def messages(spark, rows):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return df.select("conv_id", "turn", "role", chat.text_parts(F.col("text")).alias("parts"), F.lit(1).alias("formatted"), F.lit(2).alias("head"))


def test_chat_round_trip(spark):
    rows = [(1, i, "user" if i % 2 else "assistant", t) for i, t in enumerate(CONTROL)] + [(2, 0, "<|end|>", "x"), (2, 1, None, None), (3, None, "assistant", None), (None, 0, "user", "hi"),
            (4, 0, "user", "same"), (4, 0, "user", "same")]
    got = {r.conv_id: r for r in chat.read_back(chat.format_chat(messages(spark, rows))).collect()}
    assert [(t.role, t.text) for t in got[1].turns] == [(r[2], r[3]) for r in rows if r[0] == 1]
    assert got[1].learned == [t for i, t in enumerate(CONTROL) if i % 2 == 0]
    assert got[1].formatted.count("<|") == 3 * len(CONTROL)
    assert [(t.role, t.text) for t in got[2].turns] == [("<|end|>", "x"), ("", "")] and got[2].learned == []
    assert got[3].learned == [""] and len(got[4].turns) == 2 and got[None].turns[0].text == "hi"
    assert chat.format_chat(messages(spark, [])).count() == 0


def test_chat_parts(spark):
    part = lambda kind, text=None, ref=None, units=None: (kind, text, ref, units)
    rows = [(1, 0, "user", [part("text", "see "), part("image", ref="a.png", units=3), part("text", "<|image|>"), part("audio", ref="b.wav", units=4)]),
            (1, 1, "assistant", [part("document", ref="c.pdf"), part("text", "done")]), (1, 2, "user", None)]
    got = chat.format_chat(spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts {chat.PARTS}")).first()
    assert got.formatted == "<|turn|>user<|body|>see <|image|><\\|image|><|audio|><|end|><|turn|>assistant<|body|><|document|>done<|end|><|turn|>user<|body|><|end|>"
    assert [tuple(a) for a in got.attachments] == [("image", "a.png", 768), ("audio", "b.wav", 100), ("document", "c.pdf", 512)]
    assert got.attachment_tokens == 1380 and [tuple(x) for x in got.loss] == [(1, 25, 16)]


def test_control_strings_over_the_ends_of_parts(spark):
    texts = [["<", "|end|>"], ["</", "s>", "<\\", "|end|>"], ["[", "INST", "]"], ["<", None, "|turn|>x<|body|>"], ["a"], [], ["", "<|end|>"]]
    rows = [(1, i, "assistant", [("text", t, None, None) for t in parts]) for i, parts in enumerate(texts)]
    rows += [(2, 0, "user", [("text", "<", None, None), ("image", None, "a.png", None), ("text", "|end|>", None, None)]), (3, 0, "user", [("text", "<|end|>" * 30_000, None, None)])]
    got = {r.conv_id: r for r in chat.read_back(chat.format_chat(spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts {chat.PARTS}"))).collect()}
    assert [t.text for t in got[1].turns] == got[1].learned == ["".join(t or "" for t in parts) for parts in texts]
    assert [t.text for t in got[2].turns] == ["<<|image|>|end|>"] and [t.text for t in got[3].turns] == ["<|end|>" * 30_000]


def pages(spark, rows):
    from pyspark.sql import functions as F

    return spark.createDataFrame(rows, "page_id long, url string, html string").select("page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload"), F.lit(1).alias("key"))


def test_warc_round_trip_and_lookup(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 3)
    long, crlf = "é" * 60, "a\r\n\r\nWARC/1.1\r\n" * 20
    rows = [(i, f"http://h{i % 4}.example.org/p{i % 7}?q", f"page {i}") for i in range(40)]
    rows += [(50, "https://u@A.example.org:80/x", long), (41, None, long), (60, "x", long), (61, "", None), (62, "http://a", ""), (63, "http://b/\n c", crlf), (63, "http://b/\n c", crlf), (None, "http://n", "no id")]
    captures = warc.write_archives(pages(spark, rows))
    index = warc.write_index(captures)
    got = sorted(((r.page_id, r.record_type, r.refers_to, r.payload_digest, r.payload_bytes, r.payload) for r in warc.lookup(captures, index).collect()), key=str)
    want = []
    for i, _, html in rows:
        data = (html or "").encode()
        again = html == long and i != 41
        want.append((i, "revisit" if again else "response", 41 if again else None, hashlib.sha256(data).hexdigest(), len(data), None if again else bytearray(data)))
    assert got == sorted(want, key=str)
    one = spark.createDataFrame([("org,example,h1)/p1?q", 1), ("org,example,zz)/", 1)], "key string, page_id long")
    assert [r.page_id for r in warc.lookup(one, index).collect()] == [1]
    keys = {r.page_id: r.key for r in captures.collect()}
    assert keys[50] == "org,example,a:80)/x" and keys[41] == ")" and keys[60] == ")x"
    nothing = warc.write_archives(pages(spark, []))
    assert warc.lookup(nothing, warc.write_index(nothing)).count() == 0


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(packing.default_tokenizer())
    return lambda x: np.asarray(t.encode(x, add_special_tokens=False).ids, dtype="<u4")


def test_encoder_gives_the_files_ids(tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "CACHE", 50)
    e, rnd = packing.Encoder(packing.default_tokenizer()), random.Random(3)
    bits = ["a", "b ", " ", "  ", "\n", "\t", "'s", "don't", "1", "é", "<|endoftext|>", "<|endof", "text|>", "!", "中", "\r\n", " x", " ", "word", ",", " "]
    for _ in range(2000):
        t = "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 14)))
        assert e(t) == tokenizer(t).tobytes(), repr(t)


def test_every_id_is_packed_once(spark, odd, nothing, frame, tokenizer):
    docs = odd.unionByName(frame([(100 + i, "some words here " * (i * 7)) for i in range(60)] + [(500, "same size") for _ in range(30)]))
    rows = packing.pack(docs, packing.default_tokenizer(), with_ids=True).collect()
    by_seq = {}
    for r in rows:
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
        by_seq.setdefault(r.sequence_id, []).append(r)
    for parts in by_seq.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= packing.CAPACITY
    want = sorted((d.doc_id or -1, len(tokenizer(d.text or "")) + 1) for d in docs.collect())
    assert sorted((r.doc_id or -1, r.doc_tokens) for r in rows if r.start == 0) == want
    assert sum(r.length for r in rows) == sum(n for _, n in want)
    one = [r for r in rows if r.doc_id == 7]
    assert b"".join(bytes(r.ids) for r in sorted(one, key=lambda r: r.start)) == tokenizer("a b " * 4000).tobytes() + (1).to_bytes(4, "little")
    assert packing.pack(nothing, packing.default_tokenizer()).count() == 0


def test_plan_is_near_the_bound():
    rng = np.random.default_rng(1)
    for sizes in (rng.integers(1, 120, 30_000), np.full(1000, 100), np.array([256, 1, 255]), np.array([300])[:0]):
        n, c = np.unique(sizes, return_counts=True)
        plan = packing.plan(dict(zip(n.tolist(), c.tolist())), 256)
        held = {}
        for pattern, uses in plan:
            assert sum(k * s for s, k in pattern.items()) <= 256
            for s, k in pattern.items():
                held[s] = held.get(s, 0) + k * uses
        assert all(held[s] >= k for s, k in zip(n.tolist(), c.tolist()))
        used, bound = sum(u for _, u in plan), -(-int(sizes.sum()) // 256)
        assert used <= 1.01 * bound + 1 if len(n) > 3 else used in (0, 2, 500)


def plain_winnow(words, k=winnow.K, w=winnow.W):
    """Positions by the definition, over the order that the hashes induce."""
    grams = [tuple(words[i:i + k]) for i in range(len(words) - k + 1)] if len(words) >= k else [tuple(words)] if words else []
    return grams, [(max(0, i), min(len(grams), i + w)) for i in range(max(1, len(grams) - w + 1))] if grams else []


def test_winnowing(spark, odd, nothing, frame):
    rnd = random.Random(9)
    texts = [" ".join(f"w{rnd.randrange(30)}" for _ in range(rnd.choice([1, 3, 4, 6, 7, 8, 50, 300]))) for _ in range(60)] + ["a a a a a a a a a a a a", "The the, THE the the."]
    rows = {r.doc_id: r.f for r in winnow.fingerprint(frame(list(enumerate(texts))), "text", "f").collect()}
    for i, t in enumerate(texts):
        words = "".join(c if c.isalnum() else " " for c in t.lower()).split()
        grams, windows = plain_winnow(words)
        chosen = {x.at for x in rows[i]}
        by_place = {x.at: x.hash for x in rows[i]}
        assert list(by_place) == sorted(by_place)
        for lo, hi in windows:
            mine = [at for at in range(lo, hi) if at in chosen]
            assert mine  # a selected run in every window
            assert not any(grams[a] == grams[mine[-1]] for a in range(mine[-1] + 1, hi) if a not in chosen)  # the rightmost of equals
        assert len({grams[a] for a in chosen}) == len(set(by_place.values()))
    a, b = [f"x{i}" for i in range(40)], [f"y{i}" for i in range(40)]
    shared = [f"s{i}" for i in range(winnow.K + winnow.W - 1)]
    two = winnow.fingerprint(frame([(1, " ".join(a + shared + b)), (2, " ".join(b[:20] + shared + a[:7]))]), "text", "f").collect()
    assert {x.hash for x in two[0].f} & {x.hash for x in two[1].f}
    assert all(r.f == [] for r in winnow.fingerprint(odd, "text", "f").collect() if r.doc_id in (1, 2, 3))
    assert winnow.fingerprint(nothing, "text", "f").count() == 0


def test_unspaced_scripts_share_hashes(spark, frame):
    rnd = random.Random(4)
    for low, high in ((0x4E00, 0x9F00), (0x3041, 0x3090), (0xE01, 0xE2E)):
        text = "".join(chr(rnd.randrange(low, high)) for _ in range(120))
        other = "".join(chr(rnd.randrange(low, high)) for _ in range(120))
        a, b, c = winnow.fingerprint(frame([(1, text), (2, text[:80] + other[:40]), (3, other)]), "text", "f").orderBy("doc_id").collect()
        one, two, three = ({x.hash for x in r.f} for r in (a, b, c))
        assert 0.3 < len(one & two) / len(one | two) < 0.9
        assert low != 0x4E00 or not one & three


def test_next_by_descending_id(spark):
    ids = [0, 1, 5, 1023, 1024, 5000, 5001, 9_000_000, 9_000_001, 10**12, *(random.Random(1).randrange(2**62) for _ in range(40)), -7, -2**40]
    docs = spark.createDataFrame([(i, f"t{i}") for i in ids] + [(None, "none")], "doc_id long, text string")
    got = {r.doc_id: r.next.text if r.next else None for r in winnow.with_next(docs, lambda d: d, ["text"]).collect()}
    down = sorted(ids, reverse=True)
    assert got == {**{d: f"t{n}" for d, n in zip(down, down[1:] + down[:1])}, None: None}


def test_fingerprint_query(spark):
    import __spark_entry__ as E

    sf = "/root/testdata/sf0.001"
    text = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    down = sorted(text, reverse=True)
    after = dict(zip(down, down[1:] + down[:1]))
    rows = E.queries()["op10_fingerprints"](spark, sf).collect()
    print_of = {r.doc_id: {x.split(":")[1] for x in r.fingerprint.split()} for r in rows}
    assert len(rows) == len(text)
    for r in rows:
        t, cut = text[r.doc_id], len(text[r.doc_id]) // 3
        edited = t[:len(t) - cut] + text[after[r.doc_id]][:cut]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        a, b, e = print_of[r.doc_id], print_of[after[r.doc_id]], {x.split(":")[1] for x in r.edited_fingerprint.split()}
        assert r.near_next == (len(a & b) / len(a | b) if a | b else 1.0)
        assert r.near_edited == (len(a & e) / len(a | e) if a | e else 1.0)
