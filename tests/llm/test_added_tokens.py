"""Token files against the library's plain call, added tokens included."""

import random

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tickloom.llm import token_files

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def test_ids_are_those_of_the_plain_call(spark, tmp_path):
    rng = random.Random(2)
    letters = [*"ab 's\n1é日", "<|endoftext|>", "<|", "|>", " the", "<|endoftext", "  "]
    texts = ["a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|>x", "", None, "  <|endoftext|>  "]
    texts += ["".join(rng.choice(letters) for _ in range(rng.randint(0, 30))) for _ in range(400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    files = token_files.write_documents(docs, VOCABULARY, 0, str(tmp_path / "files"))
    got = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in token_files.read_documents(files).collect()}
    plain = Tokenizer.from_file(VOCABULARY)
    assert got == {i: [*plain.encode(t or "", add_special_tokens=False).ids, 0] for i, t in enumerate(texts)}
    assert got[0] == [64, 220, 50256, 275, 0]


def test_an_empty_table_has_no_files(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    files = token_files.write_documents(docs, VOCABULARY, 0, str(tmp_path / "none"))
    assert files.collect() == [] and token_files.read_documents(files).collect() == []
