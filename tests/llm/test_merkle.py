"""The Merkle manifest against trees written out in plain Python."""

from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from yardline.llm import common, merkle

H = lambda *parts: sha256("".join(parts).encode()).hexdigest()


def levels_of(leaves):
    found = [leaves]
    while len(found[-1]) > 1:
        found.append([H(*found[-1][i : i + 2]) for i in range(0, len(found[-1]), 2)])
    return found


def completed(levels, h, i):
    """Nodes below and at (h, i) in the order in which they are complete."""
    if h == 0:
        return [levels[0][i]]
    out = []
    for j in (2 * i, 2 * i + 1):
        if j < len(levels[h - 1]):
            out += completed(levels, h - 1, j)
    return [*out, levels[h][i]]


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 7, 8, 13, 16, 33])
def test_positions(n):
    levels = levels_of([f"leaf {i}" for i in range(n)])
    log = completed(levels, len(levels) - 1, 0)
    for h, level in enumerate(levels):
        assert len(level) == merkle.width(h, n)
        for i, node in enumerate(level):
            assert log[merkle.position(h, i, n)] == node


def brute(rows):
    """(id, run) in order, with leaf, subroot, root and siblings."""
    runs = {}
    for doc_id, run, text in rows:
        leaf = H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, run, text)))
        runs.setdefault(run, []).append((doc_id is not None, doc_id or 0, leaf, doc_id))
    names = sorted(runs, key=lambda r: (r is not None, (r or "").encode()))
    trees = {r: levels_of([x[2] for x in sorted(runs[r], key=lambda x: x[:3])]) for r in names}
    over = levels_of([trees[r][-1][0] for r in names])
    path = lambda levels, i: [level[(i >> h) ^ 1] for h, level in enumerate(levels) if (i >> h) ^ 1 < len(level)]
    out = []
    for at, r in enumerate(names):
        for i, x in enumerate(sorted(runs[r], key=lambda x: x[:3])):
            out.append((x[3], x[2], trees[r][-1][0], over[-1][0], tuple(path(trees[r], i) + path(over, at))))
    return out


KEY = lambda r: (r[0] is not None, r[0] or 0, r[1:])


@pytest.mark.parametrize("levels", [1, 2, 10])
def test_manifest(spark, monkeypatch, levels):
    rows = [(i, ["a", "b", None, "ä", "Z"][min(i % 7, 4)], f"text {i % 5}") for i in range(60)]
    rows += [(7, "a", "x"), (7, "a", "x"), (7, "a", "w"), (None, "b", "x"), (None, None, None), (2**62 + 1, "one", ""), (8, "b", "long " * 40_000)]
    schema = "doc_id long, run_of string, text string, size string, nodes int"
    docs = spark.createDataFrame([(*r, "s", 4) for r in rows], schema)
    text = merkle.leaf_text(F.col("doc_id"), F.col("run_of"), F.col("text"))
    leaves = docs.select("doc_id", "run_of", F.col("size").alias("kept"), merkle.digest(text).alias("leaf"), merkle.digest(F.concat(text, F.when(F.col("doc_id") % 2 == 0, "!").otherwise(""))).alias("claimed"))
    held = merkle.manifest(leaves, "run_of", ["doc_id"], "leaf", levels=levels)
    got = merkle.proofs(held, "claimed", ["doc_id", "kept"]).collect()
    want = sorted(brute(rows), key=KEY)
    found = sorted(((r.doc_id, r.digest.hex(), r.subroot.hex(), r.root.hex(), tuple(s.hex() for s in r.siblings)) for r in got), key=KEY)
    assert found == want
    assert all((r.folded == r.root) == (r.doc_id is None or r.doc_id % 2 == 1) and r.kept == "s" for r in got)
    # the builders' parts are the log, but for the nodes above them
    for r in held.log().collect():
        assert len(r.nodes) % 32 == 0
    sizes = {r.run: r.size for r in held.runs.collect()}
    logs = {}
    for r in held.log().collect():
        for i in range(len(r.nodes) // 32):
            logs.setdefault(r.run, {})[r.position + i] = r.nodes[32 * i : 32 * (i + 1)].hex()
    leaves_at = {(r["run"], r["index"]): r.digest.hex() for r in held.leaves.collect()}
    for (run, i), digest in leaves_at.items():
        assert logs[run][merkle.position(0, i, sizes[run])] == digest


def test_empty_manifest(spark):
    empty = spark.createDataFrame([], "doc_id long, lang string, leaf binary")
    held = merkle.manifest(empty, "lang", ["doc_id"], "leaf")
    assert merkle.proofs(held, "digest", ["doc_id"]).collect() == [] == held.log().collect()


def test_numbers_of_one_large_group(spark):
    rows = spark.range(5000).selectExpr("0 AS g", "id % 3 AS k").repartition(7)
    out, groups = common.numbered(common.settle(rows)[0], ["g"], ["k"])
    out = sorted((r["index"], r.k, r.size) for r in out.collect())
    assert [r[0] for r in out] == list(range(5000)) and [r[1] for r in out] == sorted(r[1] for r in out)
    assert {r[2] for r in out} == {5000} and [tuple(r) for r in groups.collect()] == [(0, 5000)]
