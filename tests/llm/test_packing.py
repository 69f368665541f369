import zlib
from collections import defaultdict
from functools import cache

import numpy as np
from tokenizers import Tokenizer

from cohortlens.llm import packing, token_matrices, tokens
from cohortlens.llm.queries import QUERIES
from tests.llm.corpus import corpus


@cache
def plain_tokenizer():
    tokenizer = Tokenizer.from_file(tokens.TOKENIZER)
    tokenizer.encode_special_tokens = True
    return tokenizer


def plain_ids(text):
    return plain_tokenizer().encode(text or "", add_special_tokens=False).ids + [0]


def test_ids_are_the_tokenizers():
    odd = ["a b", "O'Neil's  re, it's. 's", "é x", "İSTANBUL ΣΑΣ.", "aİ. İ, İ", "<|endoftext|> hi", "\x1ca\x85b", "ab..c. (d),", "", " "]
    texts = [t for t in odd + [r[1] or "" for r in corpus()]]
    assert [np.frombuffer(i, "<u4").tolist() + [0] for i in tokens.Encoder().encode([t.encode() for t in texts])] == [
        plain_ids(t) for t in texts
    ]


def test_words_too_long_to_be_remembered_are_forgotten():
    encoder, long = tokens.Encoder(), b"q" * 70
    texts = [long + b", a b", b"a " + long, b"c " * 5 + long + b"!"]
    plain = [plain_ids(t.decode())[:-1] for t in texts]
    for _ in range(2):
        assert [np.frombuffer(i, "<u4").tolist() for i in encoder.encode(texts)] == plain
        assert max(map(len, encoder.known)) <= tokens.CACHED_BYTES
    one = next(encoder.encode(texts))  # the others are never asked for
    assert np.frombuffer(one, "<u4").tolist() == plain[0] and long not in encoder.known


def test_long_texts_are_encoded_in_parts(monkeypatch):
    monkeypatch.setattr(tokens, "BLOCK_BYTES", 50)
    text = ("some words, " * 40).encode()
    assert b"".join(tokens.pieces(text)) == text and len(list(tokens.pieces(text))) > 5


def check_pieces(rows, capacity):
    expected = sorted((str(r[0]), tuple(plain_ids(r[1]))) for r in corpus())
    lengths = sorted((d, len(i)) for d, i in expected)
    crcs = defaultdict(int)
    for d, ids in expected:
        for piece, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at : at + capacity]
            crcs[d, piece, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    for r in rows:
        crcs[str(r["doc_id"]), r["piece"], r["start"], r["length"], r["ids_crc32"]] -= 1
    assert not any(crcs.values()) and lengths
    places = defaultdict(list)
    for r in rows:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for members in places.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places)


def test_residual_packing_loses_nothing_and_is_tight(docs, no_docs):
    lengths = [n for r in corpus() for size in [len(plain_ids(r[1]))] for n in [256] * (size // 256) + [size % 256] if n]
    best = len(token_matrices.best_fit_decreasing(lengths, 256))  # of all at once
    for capacity, items in ((256, 100_000), (256, 10)):
        rows = packing.packed_documents(docs.repartition(9), capacity=capacity, items=items).collect()
        sequences = check_pieces(rows, capacity)
        assert sequences <= best + (2 if items > 10 else best // 4)
    assert packing.packed_documents(no_docs).count() == 0


def test_best_fit_decreasing_agrees_with_the_segment_tree():
    lengths = np.random.default_rng(0).integers(1, 300, 2000)
    bins = packing.best_fit_decreasing(lengths, 256 + 44)
    tree = token_matrices.best_fit_decreasing(lengths.tolist(), 256 + 44)
    assert len(tree) == bins.max() + 1
    assert np.bincount(bins, lengths).max() <= 300
    assert sorted(i for items in tree for i in items) == list(range(2000))


def test_matrices_give_the_documents_back(docs, no_docs):
    got = defaultdict(dict)
    for m in token_matrices.token_matrices(docs, capacity=128, matrix_rows=4, shard_tokens=4000).collect():
        ids = np.frombuffer(m["ids"], f"<u{m['id_bytes']}").reshape(m["n_sequences"], 128)
        positions = np.frombuffer(m["positions"], "<u2").reshape(ids.shape)
        for row, (ends, segments) in enumerate(zip(m["cu_seqlens"], m["segments"], strict=True)):
            assert ends[0] == 0 and len(ends) == len(segments) + 1 and ends[-1] <= 128
            assert not ids[row, ends[-1] :].any()
            for a, b, s in zip(ends, ends[1:], segments):
                assert positions[row, a:b].tolist() == list(range(b - a)) and s["length"] == b - a
                got[s["doc_id"]].setdefault(s["start"], []).append(tuple(ids[row, a:b].tolist()))
    for doc_id, text in {r[0]: r[1] for r in corpus() if r[0] not in (50, None)}.items():
        assert [i for start in sorted(got[doc_id]) for i in got[doc_id][start][0]] == plain_ids(text)
    assert max(len(x) for x in got[50].values()) == 3
    assert token_matrices.token_matrices(no_docs).count() == 0


def test_the_registered_matrices_give_all_documents_back(spark):
    sf_dir = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    parts, sequences, tokens_held = defaultdict(dict), 0, 0
    for m in QUERIES["op1_token_matrices"](spark, sf_dir).collect():
        assert m["capacity"] == token_matrices.CAPACITY and m["n_sequences"] <= token_matrices.MATRIX_ROWS
        ids = np.frombuffer(m["ids"], f"<u{m['id_bytes']}").reshape(m["n_sequences"], m["capacity"])
        positions = np.frombuffer(m["positions"], "<u2").reshape(ids.shape)
        sequences += m["n_sequences"]
        for row, (ends, segments) in enumerate(zip(m["cu_seqlens"], m["segments"], strict=True)):
            for a, b, s in zip(ends[:-1], ends[1:], segments, strict=True):
                assert s["length"] == b - a and s["start"] not in parts[s["doc_id"]]
                assert positions[row, a:b].tolist() == list(range(b - a))
                parts[s["doc_id"]][s["start"]] = ids[row, a:b].tolist()
                tokens_held += b - a
            assert not ids[row, ends[-1] :].any() and not positions[row, ends[-1] :].any()
    whole = {}
    for doc_id, pieces in parts.items():
        whole[doc_id] = []
        for start in sorted(pieces):
            assert start == len(whole[doc_id])
            whole[doc_id] += pieces[start]
    assert whole == {doc_id: plain_ids(text) for doc_id, text in texts.items()}
    assert sequences <= -(-tokens_held // token_matrices.CAPACITY) * 1.05 + 2
