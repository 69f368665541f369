"""The registered language query over a given documents table."""

from collections import Counter

import numpy as np

from cohortlens.llm import language_id
from cohortlens.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"


def test_rows_and_held_out_accuracy_by_language(spark):
    labels = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = QUERIES["op8_language_id"](spark, SF_DIR).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(labels)
    held = [(labels[r["doc_id"]], r["lang_pred"]) for r in rows if r["held_out"] and labels[r["doc_id"]] is not None]
    asked, right = Counter(lang for lang, _ in held), Counter(lang for lang, found in held if lang == found)
    print({lang: (right[lang], n) for lang, n in sorted(asked.items())})
    assert set(asked) == {lang for lang in labels.values() if lang is not None}
    assert all(right[lang] >= 0.9 * n for lang, n in asked.items())


def plain_states(direction, data):
    """The state after each byte, one byte after the other."""
    state, states = np.zeros(len(direction.state_candidate)), []
    for byte in data:
        gates = np.clip(0.5 + 0.25 * (direction.byte_gates[byte] + state @ direction.state_gates), 0, 1)
        reset, update = np.split(gates.astype(float), 2)
        candidate = np.tanh(direction.byte_candidate[byte] + reset * (state @ direction.state_candidate))
        state = update * state + (1 - update) * candidate
        states.append(state)
    return states


def plain_pool(network, text):
    """Mean probabilities over all bytes, window by window; the last one is moved back so that it is full."""
    data, size, sums = text.encode(), language_id.WINDOW, np.zeros(len(network.languages))
    for new in range(0, len(data), size):
        start = max(min(new, len(data) - size), 0)
        window = data[start : start + size].ljust(size, b"\0")
        forward, backward = plain_states(network.forward, window), plain_states(network.backward, window[::-1])[::-1]
        for at in range(new - start, min(size, len(data) - start)):
            logits = np.concatenate((forward[at], backward[at])) @ network.weights + network.bias
            odds = np.exp(logits - logits.max())
            sums += odds / odds.sum()
    return sums / len(data)


def test_rows_match_a_network_that_reads_byte_by_byte(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    network = language_id.learned(docs)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = {r["doc_id"]: r for r in QUERIES["op8_language_id"](spark, sf_dir).collect()}
    assert set(got) == set(texts)
    some = sorted((d for d, text in texts.items() if any(map(str.isalpha, text))), key=lambda d: len(texts[d]))[:60]
    assert len({len(texts[d].encode()) > language_id.WINDOW for d in some}) == 2
    for doc_id in some:
        means = plain_pool(network, texts[doc_id])
        assert abs(got[doc_id]["score"] - means.max()) < 1e-3
        assert means[network.languages.index(got[doc_id]["lang_pred"])] > means.max() - 1e-3


def test_a_very_long_text_is_read_to_its_end(spark):
    network = language_id.train([("a", "xyx yxy xxy"), ("b", "uvu vuv uuv")], hidden=3, steps=40)
    texts = ["xyx yxy " * 40_000 + "uvu vuv " * 60_000, "xyx yxy " * 60_000 + "uvu vuv " * 40_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language_id.identify(docs, network).collect()}
    assert got[0][0] == "b" and got[1][0] == "a" and all(0.5 < score < 0.75 for _, score in got.values())
