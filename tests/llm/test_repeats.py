"""Repeats that runs of sentences with 25 words leave."""

import random
import re
from collections import Counter

import pytest

from cohortlens.llm import passages
from tests.llm.corpus import prose
from tests.llm.test_pipeline import text_key

LICENSE = "This work is licensed under the GNU General Public License, version 3."


def lines_kept(rows):
    """For each row the lines that no earlier one equals, by id (null last) and place."""
    seen, kept = {}, {}
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, text_key(rows[i][1])))
    for i in order:
        identity = rows[i][0], rows[i][1] or ""
        kept[i] = []
        for at, line in enumerate((rows[i][1] or "").split("\n")):
            words = " ".join(re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), line)))
            if words and seen.setdefault(words, (identity, at)) == (identity, at):
                kept[i].append(words)
    return kept


def test_short_repeated_lines_go_but_for_the_earliest(spark, no_docs):
    rows = [(n, f"{prose(n)}\n{LICENSE}\n{prose(50 + n)} Short one. {prose(80 + n)}") for n in range(1, 5)]
    rows += [(9, "word\n" * 3), (10, None), (1, rows[0][1])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    for drop, counted in ((passages.drop_repeated_passages, "n_lines"), (passages.drop_all_repeats, "n_removed")):
        got = {r["doc_id"]: r for r in drop(docs).collect()}
        assert got[1]["text"] == rows[0][1] and got[10]["text"] == ""
        assert all(got[n]["text"] == dict(rows)[n].replace(LICENSE, "") and got[n][counted] == 1 for n in (2, 3, 4))
        assert got[9]["text"] == "word\n\n\n"
        assert drop(docs).count() == len(rows) and drop(no_docs).count() == 0


@pytest.mark.parametrize("block,common", [(100_000, 4096), (7, 2), (7, 0)])
def test_no_line_is_left_twice(spark, monkeypatch, block, common):
    """Lines of every kind against a plain version, with blocks so small that lines meet in the shuffle, and in none."""
    monkeypatch.setattr(passages, "BLOCK", block)
    monkeypatch.setattr(passages, "COMMON", common)
    draw = random.Random(block + common)
    common_lines = [LICENSE, "Hot line", "hot  LINE", "A. B c! D?", "é ü.", "x"]
    rows = []
    for n in range(60):
        own = [f"Own line {n} number {i}." + " It has two parts." * draw.randrange(2) for i in range(draw.randrange(3))]
        lines = own + draw.choices(common_lines, k=draw.randrange(6)) + [""] * draw.randrange(2)
        draw.shuffle(lines)
        rows.append((n if n % 9 else None, "\n".join(lines)))
    rows += [(100 + n, "hot line\n" + LICENSE) for n in range(40)] + [(None, None), (None, ""), (7, rows[7][1])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = Counter()
    for r in passages.drop_repeated_passages(docs, 1000).collect():
        left = [" ".join(line.split()).lower() for line in r["text"].split("\n") if line.strip()]
        got[r["doc_id"], tuple(left), r["n_lines"]] += 1
    expected, kept = Counter(), lines_kept(rows)
    for i, (doc_id, text) in enumerate(rows):
        n = sum(bool(line.strip()) for line in (text or "").split("\n"))
        expected[doc_id, tuple(kept[i]), n - len(kept[i])] += 1
    assert got == expected


def test_passages_inside_sentences_go_wherever_they_start(spark):
    draw = random.Random(1)

    def text(n):
        return " ".join("".join(draw.choices("abcdefghij", k=5)) for _ in range(n))

    passage = text(80)
    rows = [(n, f"{text(20 + n)} {passage} {text(31 - n)}") for n in range(6)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = {r["doc_id"]: r["text"] for r in passages.drop_all_repeats(docs).collect()}
    words = passage.split()
    runs = {" ".join(words[i : i + 25]) for i in range(56)}
    assert got[0] == rows[0][1]
    for n in range(1, 6):
        before, after = rows[n][1].split(passage)
        assert got[n].startswith(before) and got[n].endswith(after) and not any(run in got[n] for run in runs)
    assert passages.drop_repeated_passages(docs).where("n_removed + n_lines > 0").count() == 0
