import zlib

import numpy as np
from tokenizers import Tokenizer

from cohortlens.llm import packing, tokens

TEXTS = ["end <|endoftext|> of", "a<|startoftext|>b", "<|ENDOFTEXT|> x", "<| endoftext|>", "plain words, here", "", "x <|endoftext|>"]


def test_packed_ids_of_special_strings_are_the_plain_calls(spark):
    plain = Tokenizer.from_file(tokens.TOKENIZER)
    expected = [plain.encode(t, add_special_tokens=False).ids + [0] for t in TEXTS]
    assert expected[0] == [806, 49407, 539, 0]
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string").repartition(2)
    got = {r["doc_id"]: (r["length"], r["ids_crc32"]) for r in packing.packed_documents(docs).collect()}
    assert got == {i: (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for i, ids in enumerate(expected)}
