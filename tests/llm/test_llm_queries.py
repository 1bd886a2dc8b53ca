"""The registered queries over the given tables, and the pipeline."""

import json
import re
import subprocess
import sys
import zlib
from pathlib import Path

import public_tokenizers
import pytest
from compare import compare, connect
from llm_brute import WORD, leaks, near_duplicates, repeated_bytes, repeated_words, sha
from tokenizers import Tokenizer

import corpus_pipeline
from yardline.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
TOKENIZER = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
TOKENIZER.no_truncation()
TOKENIZER.no_padding()


@pytest.fixture(scope="module")
def documents(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]


def rows(spark, name):
    return sorted(tuple(r) for r in QUERIES[name](spark, FOLDER).collect())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_reference_sql(spark, name):
    difference = compare(QUERIES[name](spark, FOLDER), connect(FOLDER), ORACLES[name])
    assert difference is None, difference


def test_op1(spark, documents):
    assert rows(spark, "op1_suffix_array_dedup") == sorted((*r[:4], sha(r[4])) for r in repeated_bytes(documents))


def test_op2(spark, documents):
    assert rows(spark, "op2_substring_dedup") == sorted((*r[:3], sha(r[3])) for r in repeated_words(documents))


def test_op3(spark, documents):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    got = [(*r[:4], round(r[4], 9)) for r in rows(spark, "op3_benchmark_decontamination")]
    assert got == sorted(leaks(documents, items))


def tokens(text):
    ids = TOKENIZER.encode(text or "", add_special_tokens=False).ids
    return ids, TOKENIZER.decode(ids, skip_special_tokens=False)


def test_op5(spark, documents):
    want = [(d, len(ids), sha(" ".join(map(str, ids))), sha(back)) for d, (ids, back) in ((d, tokens(t)) for d, t in documents)]
    assert rows(spark, "op5_bpe") == sorted(want)


def test_op6(spark, documents):
    assert rows(spark, "op6_simhash_near_dedup") == sorted(near_duplicates(documents))


def test_op7(spark, documents):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    got = QUERIES["op7_language_id"](spark, FOLDER).collect()
    assert len(got) == len(documents)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.9 * len(held)


def test_op8(spark, documents):
    got = QUERIES["op8_token_counts"](spark, FOLDER).groupBy("doc_id").sum("n_tokens").collect()
    counter = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert {r[0]: r[1] for r in got} == {d: len(counter.encode(t or "").ids) for d, t in documents}


def test_op10(spark, documents):
    got = {r.doc_id: r for r in QUERIES["op10_quality_classifier"](spark, FOLDER).collect()}
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").collect()
    assert len(got) == len(documents)
    assert sum(got[r.doc_id].kept == bool(r.quality) for r in labels) >= 0.85 * len(labels)


def test_pipeline(spark, documents):
    """Each stage on what its predecessor kept."""
    kept = {r.doc_id for r in QUERIES["op9_quality_rules"](spark, FOLDER).collect() if r.kept}
    docs = sorted(d for d in documents if d[0] in kept)
    docs = [d for d, (i, _, c) in zip(docs, near_duplicates(docs), strict=True) if i == c]
    texts = dict(docs)
    docs = [(i, kept if removed else texts[i]) for i, _, removed, kept in repeated_words(docs)]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    leaked = {r[0] for r in leaks(docs, items)}
    want = [(i, t, *tokens(t)) for i, t in docs if i not in leaked]
    out = corpus_pipeline.run(spark, FOLDER)
    assert sorted((r.doc_id, r.text, r.token_ids, r.decoded) for r in out.collect()) == want
    assert len(leaked) > 0 and 0 < len(want) < len(documents) - 10


def test_stages_take_odd_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, kept int, r1 string"
    text = " ".join(f"word{i}" for i in range(80))
    rows = [(1, text, "en", None, None, 1, "a"), (1, text, "en", None, None, 1, "a"), (None, text + " x", None, "s", 3, 2, "b")]
    rows += [(4, None, "en", "s", 0, 3, "c"), (5, "", "en", "s", 0, 3, "c"), (6, "a" * 10_000 + " b" * 30_000, "en", "s", 0, 3, "c")]
    for source in (rows, []):
        docs = spark.createDataFrame(source, schema)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, FOLDER)
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "kept", "r1"]
        out = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).collect()
        assert {(r.doc_id, r.kept, r.r1) for r in out} == ({(1, 1, "a"), (None, 2, "b")} if source else set())
        assert len(out) == (2 if source else 0)


def test_native_query_has_no_python(spark):
    plan = QUERIES["op9_quality_rules"](spark, FOLDER)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|ExistingRDD", plan)


def test_nothing_else_imports_these_modules():
    root = Path(__file__).resolve().parents[2]
    for path in [*root.glob("yardline/**/*.py"), *root.glob("tests/*.py"), root / "bench.py"]:
        if "llm" not in path.relative_to(root).parts:
            assert "yardline.llm" not in path.read_text(), path


def test_entry_lists_all():
    root = Path(__file__).resolve().parents[2]
    code = "import json, __spark_entry__ as e; print(json.dumps(sorted(e.queries())))"
    names = json.loads(subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, check=True).stdout)
    assert "pipeline" in names
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in names if re.match(r"op\d+_", n)) == list(range(1, 14))
    assert WORD.findall("a\x0bb") == ["a", "b"]
