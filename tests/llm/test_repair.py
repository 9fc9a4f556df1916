"""Conversation repair against an exhaustive plain version."""

import hashlib
import random
import zlib

import pytest

from mensura.llm import repair as R

SCHEMA = "conv_id long, turn long, role string, text string"


def least(rows):
    """Forward search over (cost, audit) of every state."""
    far = (10 ** 9, "")

    def close(s):
        def more(x):
            return (x[0] + 3, x[1] + "I") if x[0] < 10 ** 9 else far
        u = min(s[2], *[more(s[k]) for k in (0, 1, 3)])
        return [s[0], s[1], u, min(s[3], more(u))]

    s = close([(0, ""), far, far, far])
    for r in rows:
        n = [far] * 4
        for q in range(4):
            if s[q][0] >= 10 ** 9:
                continue
            ways = [(4, q, "D")]
            if not r & 4:
                extra = 3 if r & 8 else 0
                to = {(0, 1): 1, (0, 2): 2, (1, 2): 2, (3, 2): 2, (2, 3): 3}.get((q, r & 3))
                if to is not None:
                    ways.append((extra, to, "K"))
                ways.append((3 + extra, 3 if q == 2 else 2, "R"))
            for c, j, a in ways:
                n[j] = min(n[j], (s[q][0] + c, s[q][1] + a))
        s = close(n)
    return min(s[0], s[3])


def test_auction_finds_the_least_cheapest_edits():
    rng = random.Random(5)
    for size in [*range(10)] * 60 + [63, 64, 65, 128, 129, 300]:
        rows = bytes(rng.choice([0, 1, 2, 2, 3, 3]) | rng.choice([0, 0, 0, 4, 8]) for _ in range(size))
        assert R.cheapest_edits(rows) == least(rows)


def test_prices_stay_feasible_and_are_exact_at_origins():
    rows = bytes([2, 3, 3, 2 | 8, 4, 3])
    arcs, prices = R.lattice(rows, (0, R.FAR, R.FAR, 0), True), R.first_prices(rows, (0, R.FAR, R.FAR, 0))
    R.auction(arcs, prices, [0])
    assert all(prices[i] <= c + prices[j] for i, own in enumerate(arcs) for c, j, _ in own)
    assert prices[0] == least(rows)[0]


def plain(rows, ids):
    """rows: (conv, turn, role, text) after damage."""
    out = []
    for conv in ids:
        own = sorted(((t, r if r is not None else " ", x if x is not None else " ") for c, t, r, x in rows if c == conv),
                     key=lambda y: (y[0] is not None, y[0] or 0, y[1], hashlib.sha256(y[2].encode()).hexdigest()))
        seen, codes, count = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
        for t, r, x in own:
            solid = x.rstrip(" \t\n\x0b\x0c\r")
            kind = "blank" if not solid else "duplicate" if (r, x) in seen else "truncated" if solid[-1] not in ".!?" else None
            seen.add((r, x))
            if kind:
                count[kind] += 1
            codes.append({"s": 1, "u": 2, "a": 3}.get(r[:1], 0) | {"blank": 4, "duplicate": 4, "truncated": 8, None: 0}[kind])
        cost, audit = least(codes)
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        made, at = [], 0
        for e in audit:
            last = made[-1][0][:1] if made else ""
            want = "assistant" if last == "u" else "user"
            if e == "I":
                made.append((want, ""))
                continue
            _, r, x = own[at]
            at += 1
            if e != "D":
                made.append((r if e == "K" else want, x))
        sha = hashlib.sha256("\n".join(f"{r}:{x}" for r, x in made).encode()).hexdigest()
        out.append((conv, gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit, sha))
    return sorted(out, key=str)


def harm(rows):
    out = []
    for c, t, r, x in rows:
        name = f"{' ' if c is None else c}:{' ' if t is None else t}"
        fault = zlib.crc32(name.encode()) % 20
        r, x = " " if r is None else r, " " if x is None else x
        if fault == 0:
            continue
        x = "" if fault == 1 else x.translate({ord(k): None for k in ".!?"}) if fault == 2 else x
        out += [(c, t, "user" if fault == 4 else r, x)] * (2 if fault == 3 else 1)
    return out


@pytest.fixture(scope="module")
def talk():
    rng = random.Random(11)
    texts = ["Yes.", "No!", "cut off", "", " \n", None, "Long " * 3000 + ".", "Ünï?  ", "Yes."]
    rows = [(c, t, rng.choice(["user", "assistant", "user", "assistant", "system", None, "tool", ""]), rng.choice(texts))
            for c in [*range(60), None] for t in [*range(rng.randint(0, 9)), None][:rng.randint(1, 10)]]
    rows += [(1000, t, "user" if t % 2 == 0 else "assistant", f"Turn {t // 5}.") for t in range(0, 900, 3)]
    return rows + rng.sample(rows, 40)  # repeated rows


@pytest.mark.parametrize("batch", [3, 500])
def test_same_as_plain_version(spark, talk, batch):
    from pyspark.sql import functions as F

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        df = spark.createDataFrame(talk, SCHEMA).withColumn("id", F.lit("x")).withColumn("audit", F.lit(1)).withColumn("head", F.lit(1))
        got = R.repair(R.damaged(df), df)
        assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
        assert sorted(map(tuple, got.collect()), key=str) == plain(harm(talk), {c for c, *_ in talk})
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")


def test_no_rows(spark):
    void = spark.createDataFrame([], SCHEMA)
    assert R.repair(void, void).count() == 0
    ids = spark.createDataFrame([(1, 0, "user", "Hi.")], SCHEMA)
    assert [tuple(r) for r in R.repair(void, ids).collect()] == [(1, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
