import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from panelwright.llm import packing

TOKENIZER = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def ids_of(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids + [1]


def check(docs, length=2048):
    rows = docs.select("doc_id", "text").collect()
    got = packing.pack(docs, length).toPandas()
    left = {}
    for r in rows:
        left.setdefault(r["doc_id"], []).append(ids_of(r["text"]))
    assert got["length"].sum() == sum(len(i) for v in left.values() for i in v) and (got["length"] > 0).all()
    for doc_id, texts in left.items():
        if len(texts) > 1:
            continue
        own = got[got["doc_id"] == doc_id].sort_values("start") if doc_id is not None else got[got["doc_id"].isna()].sort_values("start")
        at = 0
        for p in own.itertuples():
            assert p.start == at and p.doc_tokens == len(texts[0])
            assert p.ids_crc32 == zlib.crc32(np.array(texts[0][at : at + p.length], "<u4").tobytes())
            at += p.length
        assert at == len(texts[0])
    by = got.sort_values(["sequence_id", "offset"]).groupby("sequence_id")
    for _, s in by:
        assert (s["offset"].to_numpy() == np.r_[0, s["length"].cumsum()[:-1]]).all()
        total = s["length"].sum()
        assert total <= length and (total == length or total & (total - 1) == 0) and (s["padded_length"] == total).all()


def test_pieces_of_documents(documents):
    check(documents)


def test_messy_rows(messy):
    check(messy)
    check(messy, 7)


def test_small_and_empty_tables(spark, empty):
    assert packing.pack(empty).count() == 0
    check(spark.createDataFrame([(1, None)], "doc_id long, text string"))
    check(spark.createDataFrame([(1, "word " * 5000)], "doc_id long, text string"))


def test_layout_does_not_change_the_result(messy):
    plain = messy.where("doc_id is not null")
    key = lambda df: sorted(map(str, packing.pack(df, 64).collect()))
    assert key(plain) == key(plain.repartition(7, "text"))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.characters(blacklist_categories=("Cs",)), max_size=60))
def test_fast_encoder_gives_the_ids_of_the_json_form(text):
    assert packing.token_ids(text).tolist() == ids_of(text)


@pytest.mark.parametrize("text", ["<|endoftext|>", "a<|endoftext|>b <|endoftext|>", "  \n\n\t x", "it's we'll I'M", "١٢٣ ½ ²", "\x00\x01", "a b c", "한국어 日本語", "x" * 5000, " " * 3000])
def test_fast_encoder_on_special_texts(text):
    assert packing.token_ids(text).tolist() == ids_of(text)


def test_hilbert_curve_visits_neighbours():
    for dims, bits in ((2, 4), (3, 3)):
        side = 1 << bits
        points = np.stack(np.meshgrid(*[np.arange(side)] * dims, indexing="ij"), -1).reshape(-1, dims)
        keys = packing.hilbert_key(points, bits)
        assert sorted(keys.tolist()) == list(range(side**dims))
        path = points[np.argsort(keys)]
        assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def test_similar_documents_lie_closer_than_others():
    rng = random.Random(4)
    topics = [[f"{t}{rng.randrange(999)}" for _ in range(40)] for t in ("alpha", "beta", "gamma", "delta")]
    texts = [" ".join(rng.choice(topic) for _ in range(300)) for topic in topics for _ in range(10)]
    order = np.argsort(packing.curve_keys([packing.token_ids(t) for t in texts]))
    same = sum(a // 10 == b // 10 for a, b in zip(order, order[1:]))
    assert same >= 25
