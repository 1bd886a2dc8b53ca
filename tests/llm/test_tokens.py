"""BPE and token counts against the tokenizers library."""

import bisect
import random
import unicodedata

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from yardline.llm.bpe import decode, encode, encode_and_decode, vocabulary
from yardline.llm.token_counts import section_tokens

FILES = ("word_bpe_49k.json", "byte_bpe_50k.json")
ODD = [
    None, "", " ", "\n\n", "it's WE'LL 're", "a<|startoftext|>B<|endoftext|><|endoftext|>c <|x", "ΑΣ ς Σ İ ﬁ Å", "x\x1cy\x1f z\x85w\xa0v", "½²Ⅷ٣",
    "  two  spaces \n here\n", "é̂ 😀😀 漢字", "</w> </w", "x" * 20_000, "ab" * 9000 + " " + "-" * 500, "\x00\x01",
]


def library(name):
    t = Tokenizer.from_file(public_tokenizers.path(name))
    t.no_truncation()
    t.no_padding()
    return t


LIBRARY = {n: library(n) for n in FILES}


@pytest.mark.parametrize("name", FILES)
def test_documents_and_odd_texts(spark, name):
    path = public_tokenizers.path(name)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    rows += [(None, t) for t in ODD] + rows[:2]
    docs = spark.createDataFrame([(*r, "x", 5) for r in rows], "doc_id long, text string, Token_Ids string, decoded int")
    out = decode(encode(docs, path), path).collect()
    assert len(out) == len(rows)
    for r in out:
        ids = LIBRARY[name].encode(r.text or "", add_special_tokens=False).ids
        assert r.token_ids == ids, r.text
        assert r.decoded == LIBRARY[name].decode(ids, skip_special_tokens=False)
    assert encode_and_decode(docs, path).collect() == out
    assert encode(docs.limit(0), path).collect() == [] == encode_and_decode(docs.limit(0), path).collect()


ASSIGNED = st.characters(exclude_categories=("Cs", "Cn", "Co"), max_codepoint=0x2FFF)


@pytest.mark.parametrize("name", FILES)
@settings(max_examples=300, deadline=None)
@given(text=st.text(st.one_of(ASSIGNED, st.sampled_from(" \n\t'<|>abcthe")), max_size=60))
def test_any_text(name, text):
    if any(unicodedata.combining(c) for c in text):
        text = unicodedata.normalize("NFC", text)  # orders of marks differ between Unicode versions
    words = vocabulary(public_tokenizers.path(name))
    ids = words.encode(text)
    want = LIBRARY[name].encode(text, add_special_tokens=False).ids
    assert ids.tolist() == want
    assert words.decode(ids, np.array([len(ids)])) == [LIBRARY[name].decode(want, skip_special_tokens=False)]


def test_round_trip_of_bytes_and_unknown_ids(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    rows = spark.createDataFrame([([72, None, -4, 10**6, 73],), (None,), ([],)], "token_ids array<int>")
    words = vocabulary(path)
    assert [r.decoded for r in decode(rows, path).collect()] == [words.names[72] + words.names[73], "", ""]
    rng = random.Random(1)
    texts = ["".join(rng.choice("ab é\n漢😀") for _ in range(50)) for _ in range(50)]
    ids = [words.encode(t) for t in texts]
    assert words.decode(np.concatenate(ids), np.array([len(x) for x in ids])) == texts


def sections(text, starts, rule):
    tokens = LIBRARY["byte_bpe_50k.json"].encode(text or "", add_special_tokens=False).offsets
    n, crossing = [0] * len(starts), [0] * len(starts)
    for a, b in tokens:
        own = bisect.bisect_right(starts, a) - 1
        last = bisect.bisect_right(starts, max(b - 1, a)) - 1
        if rule == "most":
            edges = [*starts, len(text)]
            chars = [min(b, edges[i + 1]) - max(a, edges[i]) for i in range(len(starts))]
            best = max(chars, default=0)
            final = chars.index(best) if last > own else own
        else:
            final = own
        n[final] += 1
        crossing[final] += last > own
    return list(zip(range(len(starts)), starts, [*starts[1:], len(text or "")], n, crossing, strict=True))


@pytest.mark.parametrize("rule", ["first", "most"])
def test_sections(spark, rule):
    rng = random.Random(2)
    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = [t for t in ODD if t != ODD[5]] + ["".join(rng.choice("the ing\n é漢😀.") for _ in range(rng.randrange(80))) for _ in range(60)]
    places = [sorted(rng.sample(range(1, len(t)), min(3, len(t) - 1))) if t and len(t) > 1 else [] for t in texts]
    docs = spark.createDataFrame([(i, t, p, 1) for i, (t, p) in enumerate(zip(texts, places, strict=True))], "doc_id long, text string, at array<long>, Sections int")
    for spans in (None, "at"):
        out = section_tokens(docs, path, spans_col=spans, rule=rule).collect()
        for r in out:
            text = r.text or ""
            starts = [0, *(r["at"] if spans else [i + 1 for i, c in enumerate(text) if c == "\n" and i + 1 < len(text)])]
            assert [tuple(x) for x in r.sections] == sections(text, starts, rule), text
    assert section_tokens(docs.limit(0), path).collect() == []
