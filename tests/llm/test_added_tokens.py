"""Texts that hold an added token's string: ids, spans and the registered queries against the library at its defaults."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from jobloom.llm import hf_ids, queries

PATH = public_tokenizers.path("byte_bpe_50k.json")
LONG = " " * 6000 + "<|endoftext|>"
TEXTS = ["a<|endoftext|>b", "<|endoftext|>", "one\n<|endoftext|>\ntwo <|endoftext|> é", "no token <|endoftext>", ""]


def test_ids_and_spans_are_the_librarys(rng):
    made, read, spans = Tokenizer.from_file(PATH), hf_ids.reader(PATH, special=True), hf_ids.spans(PATH, special=True)
    parts = ["the", " ", "\n", "é", "漢", "'s", "<|endoftext|>", "<|", "\U0001f600"]
    for text in [*TEXTS, LONG] + ["".join(rng.choices(parts, k=rng.randint(0, 20))) for _ in range(300)]:
        wanted = made.encode(text, add_special_tokens=False)
        assert read(text).tolist() == wanted.ids
        starts, ends = spans(text)
        assert list(zip(starts.tolist(), ends.tolist(), strict=True)) == wanted.offsets
    assert read("a<|endoftext|>b").tolist() == [64, 50256, 65] and len(hf_ids.reader(PATH)("a<|endoftext|>b")) == 9


def test_queries_read_added_tokens(spark, tmp_path):
    made = Tokenizer.from_file(PATH)
    spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    ids = [made.encode(t, add_special_tokens=False).ids for t in TEXTS]
    packed = {r.doc_id: r for r in queries.op5_best_fit_packing(spark, str(tmp_path)).collect()}
    for k, row in enumerate(ids):
        assert (packed[k].length, packed[k].ids_crc32) == (len(row) + 1, zlib.crc32(np.array([*row, 2], "<u4").tobytes()))
    counts = queries.op3_token_counts(spark, str(tmp_path)).groupBy("doc_id").sum("n_tokens").collect()
    assert {r[0]: r[1] for r in counts} == {k: len(row) for k, row in enumerate(ids)}
