import re
import zlib

import duckdb
import numpy as np

from checks.compare import differences
from cohortlens.llm import chat, language_id, passages, secrets
from cohortlens.llm.queries import SQL
from tests.llm.corpus import prose

KEY = "AKIA" + "Q" * 17
TEXTS = [
    (1, f'x password = "abcdef12" and {KEY} end'),
    (2, "PassWord:abc api-key=zzzzzzz apikey='k3y.v4lue' " + "0123456789abcdef" * 2),
    (3, "secret" * 50 + " token=" + "t" * 9000),
    (4, None), (5, ""), (6, "é api_KEY : 'abcdefgh' Key toKen=abcdefg"),
    (7, "-----BEGIN RSA PRIVATE KEY----- ghp_" + "a1" * 20), (1, "repeated id token:abcdefg"), (None, "token:abcdefg"),
]


def test_secrets_match_a_scan_without_index(spark, no_docs):
    docs = spark.createDataFrame(TEXTS, "doc_id bigint, text string").repartition(2)
    got = sorted((str(r["doc_id"]), [(s["kind"], s["start"], s["end"]) for s in r["found"]]) for r in secrets.find_secrets(docs).collect())
    expected = []
    for doc_id, text in TEXTS:
        spans = sorted((s, o, e) for o, rule in enumerate(secrets.RULES) for s, e in rule.spans(text or ""))
        expected.append((str(doc_id), [(secrets.RULES[o].kind, s, e) for s, o, e in spans]))
    assert got == sorted(expected) and sum(len(s) for _, s in got) >= 9
    assert secrets.find_secrets(no_docs).count() == 0


def test_queries_of_patterns():
    query = secrets.trigram_query
    assert query("[0-9a-f]+") is None and query("(abc|x)y*") is None and query("(abcd)?") is None
    assert query("abcd") == [{b"abc", b"bcd"}] and query("(?:abc){2}") == [{b"abc", b"bca", b"cab"}]
    assert query("abc.*def") == [{b"abc", b"def"}] and query("(abc|def)+") == [{b"abc"}, {b"def"}]
    assert secrets.RULES[2].clauses is None and all(r.clauses for r in secrets.RULES if r.kind != "hex")


def test_a_kept_index_gives_the_same_candidates(spark):
    docs = spark.createDataFrame([t for t in TEXTS if t[0] is not None], "doc_id bigint, text string")
    found = {(r["kind"], r["doc_id"]) for r in secrets.candidates(secrets.build_index(docs)).collect()}
    for doc_id, text in TEXTS:
        for rule in secrets.RULES:
            if doc_id is not None and rule.clauses and re.search(rule.pattern, text or "", re.ASCII):
                assert (rule.kind, doc_id) in found
    assert ("access", 2) not in found and ("private_key", 1) not in found


def test_repeated_passages_go_wherever_they_start(spark, no_docs):
    passage = prose(99, 4)
    rows = [(1, "One own start here. " + passage + " And an own end."), (2, passage), (3, "Mine.\n" + passage + "\nTail. " + prose(7)),
            (4, prose(8)), (5, None), (6, ""), (7, "Short one. " + prose(9)), (8, "Short one. " + prose(10)), (2, passage)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = {r["doc_id"]: r for r in passages.drop_repeated_passages(docs).collect()}
    assert passages.drop_repeated_passages(docs).count() == len(rows)
    assert got[1]["n_removed"] == 0 and got[2]["text"] == "" and got[3]["text"] == "Mine.\n\nTail. " + prose(7)
    assert all(got[i]["n_removed"] == 0 and got[i]["text"] == (dict(rows)[i] or "") for i in (4, 5, 6, 7, 8))
    text = dict(rows)[3]
    assert "".join(text[s["start"] : s["end"]] for s in got[3]["kept"]) == got[3]["text"]
    assert passages.drop_repeated_passages(no_docs).count() == 0


def chats(spark, rows):
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(5)


def test_snapshots_collapse_into_the_longest_log(spark):
    log = [(0, "user", "hi"), (1, "assistant", "hello"), (2, "user", None), (3, None, "bye")]
    rows = [(c, *t) for c, n in ((1, 2), (2, 4), (3, 4), (4, 1)) for t in log[:n]]
    rows += [(5, 0, "user", "hi"), (5, 1, "assistant", "other"), (6, 0, "user", "alone"), (6, 0, "user", "alone"), (None, None, None, None)]
    got = {(r["conv_id"], r["part"]): r for r in chat.format_chats(chats(spark, rows), 3).collect()}
    assert set(got) == {(2, 0), (2, 1), (5, 0), (6, 0), (None, 0)}
    assert got[2, 0]["copies"] == 2 and got[2, 1]["text"] == "<|unknown|>\nbye\n"
    assert got[2, 0]["text"] == "<|user|>\nhi\n<|assistant|>\nhello\n<|user|>\n\n"
    assert chat.format_chats(chats(spark, [])).count() == 0


def test_turns_that_tie_are_in_order_of_role_and_text(spark, tmp_path):
    tied = [(1, 1, "user", t) for t in "bca"] + [(1, 1, None, "a"), (1, 1, "assistant", None), (1, 1, "assistant", "z")]
    tied += [(2, 1, "user", t) for t in "ba"] + [(2, None, "user", "last"), (2, 2, None, None), (2, 2, None, "x" * 99)]
    tied += [(3, 1, "user", t) for t in "ab"] + [(4, 1, "user", "same")] * 3 + [(None, 1, "user", t) for t in "dc"]
    tied += [(6, 1, "user", "y" * 80 + t) for t in "cab"] + [(6, 1, "user", "é"), (6, 1, "user", "z")]
    frame = chats(spark, tied)
    got = chat.format_chats(frame)
    texts = {r["conv_id"]: r["text"] for r in got.collect()}
    assert texts[1] == "".join(
        f"<|{role}|>\n{text}\n"
        for role, text in [("assistant", "z"), ("assistant", ""), ("user", "a"), ("user", "b"), ("user", "c"), ("unknown", "a")]
    )
    assert set(texts) == {1, 2, 4, None, 6}  # 3 is a snapshot of 2
    frame.write.parquet(f"{tmp_path}/conversations.parquet")
    database = duckdb.connect()
    database.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    expected = database.execute(SQL["op7_chat_snapshots"]).df()
    # a join that takes a null conv_id for one is beyond the USING of the SQL
    assert differences(got.where("conv_id is not null").toPandas(), expected[expected["conv_id"].notna()]) == ""


def test_a_very_long_conversation_spans_partitions(spark):
    rows = [(1, i, "user", f"t{i}") for i in range(1500)] + [(2, i, "user", f"t{i}") for i in range(700)]
    rows += [(c, 0, "user", f"o{c}") for c in range(10, 500)]
    parts = chat.format_chats(chats(spark, rows), 100)
    text = "".join(r["text"] for r in parts.where("conv_id = 1").orderBy("part").collect())
    assert text == "".join(f"<|user|>\nt{i}\n" for i in range(1500)) and parts.where("conv_id = 2").count() == 0


def test_languages_are_told_apart_on_held_out_documents(spark, no_docs):
    rng = np.random.default_rng(0)
    sounds = {"aa": ["ka", "ro", "mi", "tu"], "bb": ["sch", "ung", "ein", "ö"]}
    rows = []
    for i in range(240):
        lang = ("aa", "bb")[i % 2]
        text = " ".join("".join(rng.choice(sounds[lang], 3)) for _ in range(int(rng.integers(20, 90))))
        rows.append((i, text, None if i % 40 == 0 else lang))
    rows += [(900, None, "aa"), (901, "12 34 !", "bb"), (902, "", None), (None, rows[1][1], "bb"), (3, rows[3][1] * 50, "bb")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    network = language_id.train(language_id.sample(docs, 60), steps=80)
    held = docs.withColumn("held", language_id.held_out())
    flags = {r["doc_id"]: r["held"] for r in held.collect()}
    assert all(flags[i] == (zlib.crc32(str(i).encode()) % 4 == 2) for i in range(240)) and flags[None] is False
    got = [r for r in language_id.identify(docs, network).collect()]
    assert len(got) == len(rows)
    by_id = {r["doc_id"]: r for r in got}
    assert {by_id[i]["lang_pred"] for i in (900, 901, 902)} == {"und"}
    right = [by_id[i]["lang_pred"] == ("aa", "bb")[i % 2] for i in range(240) if flags[i]]
    assert np.mean(right) > 0.95 and all(0 <= r["score"] <= 1 for r in got)
    assert language_id.learned(no_docs) is None and language_id.identify(no_docs, None).count() == 0


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(1)
    network = language_id.train([("a", "xyx"), ("b", "uvu")], hidden=3, steps=1)
    steps, labels = rng.integers(1, 9, (6, 4)), np.array([0, 1, 1, 0])
    steps[4:, 1] = 0
    _, gradients = network.loss_gradients(steps, labels)
    for values, gradient in zip(network.parameters(), gradients, strict=True):
        at = np.unravel_index(np.abs(gradient).argmax(), gradient.shape)
        kept = values[at]
        losses = []
        for by in (0.01, -0.01):
            values[at] = kept + by
            losses.append(network.loss_gradients(steps, labels)[0])
        values[at] = kept
        assert abs((losses[0] - losses[1]) / 0.02 - gradient[at]) < 2e-3


def test_units_split_the_text():
    text = "One. Two two!\nThree? four\n\n five\nSix. \n"
    kinds = {passages.PIECE: "piece", passages.LINE: "line", passages.PIECE | passages.LINE: "both"}
    assert [(u, text[a:b], n, kinds[k]) for u, a, b, n, _, k in passages.units_of(text)] == [
        (0, "One.", 1, "piece"), (1, " Two two!", 2, "piece"), (0, "One. Two two!", 3, "line"),
        (2, "Three?", 1, "piece"), (3, " four", 1, "piece"), (2, "Three? four", 2, "line"), (4, " five", 1, "both"), (5, "Six.", 1, "both"),
    ]
