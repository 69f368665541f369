import hashlib
import re
from collections import Counter, defaultdict

from xxhash import xxh64_intdigest

from cohortlens.llm import exact_dedup, simhash
from cohortlens.llm.components import components
from tests.llm.corpus import corpus, words


def plain_exact(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        bare = re.sub(r"[\x20\x09-\x0D]", "", text or "")
        groups[hashlib.sha256(bare.encode()).hexdigest()].append((-len(text or ""), doc_id is None, doc_id or 0, doc_id))
    return groups


def test_exact_duplicates_match_a_plain_version(docs):
    groups = plain_exact([r[:2] for r in corpus()])
    for slots in (2, 1024):
        got = exact_dedup.exact_duplicates(docs, slots).collect()
        assert len(got) == len(corpus())
        by_digest = defaultdict(list)
        for r in got:
            by_digest[r["digest"].hex()].append(r)
        assert set(by_digest) == set(groups)
        for digest, members in by_digest.items():
            assert {r["keep_id"] for r in members} == {min(groups[digest])[3]}
            assert {r["group_size"] for r in members} == {len(groups[digest])}
            assert sum(r["kept"] for r in members) == 1


def test_a_hot_digest_is_decided_before_the_shuffle(spark):
    rows = [(i, "copy") for i in range(300)] + [(1000 + i, f"text {i}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(8)
    assert [bytes(r[0]).hex() for r in exact_dedup.frequent(exact_dedup.digests(docs), 1).collect()] == [
        hashlib.sha256(b"copy").hexdigest()
    ]
    kept = exact_dedup.exact_duplicates(docs, 1).where("kept")
    assert sorted(r[0] for r in kept.select("doc_id").collect()) == [0, *range(1000, 1300)]


def test_a_hot_text_without_ids_sends_one_row_to_the_shuffle(spark):
    rows = [(None, "copy")] * 400 + [(5, "co py")] * 3 + [(i, f"text {i}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(8)
    marks = exact_dedup.exact_duplicates(docs, 2)
    got = Counter((r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in marks.where("group_size > 1").collect())
    assert got == {(None, 5, 403, False): 400, (5, 5, 403, False): 2, (5, 5, 403, True): 1}
    spark.conf.set("spark.sql.maxMetadataStringLength", 10000)
    plan = marks._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    shuffled = plan[plan.index("Window [") :]
    assert "place" in shuffled[: shuffled.index("FileScan")]  # rows are told apart before the exchange of the window
    nulls = spark.createDataFrame([(None, "copy")] * 200, "doc_id bigint, text string")
    assert [r["kept"] for r in exact_dedup.exact_duplicates(nulls, 1).collect()].count(True) == 1
    assert exact_dedup.drop_exact_duplicates(nulls, 1).count() == 1


def test_exact_stage_keeps_one_row_of_each_group_and_all_columns(docs, no_docs):
    kept = exact_dedup.drop_exact_duplicates(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len(plain_exact([r[:2] for r in corpus()]))
    assert exact_dedup.drop_exact_duplicates(no_docs).count() == 0


def plain_fingerprint(text):
    w = words("".join(c.lower() if c.isascii() else c for c in text or ""))
    shingles = [" ".join(w[i : i + 3]) for i in range(max(len(w) - 2, 1))] if w else []
    hashes = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows):
    fps = [(i, plain_fingerprint(t)) for i, t in rows]
    parent = list(range(len(fps)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i][1] ^ fps[j][1]).bit_count() <= 2:
                parent[root(i)] = root(j)
    ids = defaultdict(list)
    for i, (doc_id, _) in enumerate(fps):
        ids[root(i)].append(doc_id)
    least = {k: min((x for x in v if x is not None), default=None) for k, v in ids.items()}
    return Counter((doc_id, fp, least[root(i)]) for i, (doc_id, fp) in enumerate(fps)), len(ids)


def test_simhash_matches_a_plain_version(docs, no_docs):
    expected, groups = plain_components([r[:2] for r in corpus()])
    got = Counter(
        (r["doc_id"], r["fp"] % (1 << 64), r["component_id"]) for r in simhash.near_duplicates(docs).collect()
    )
    assert got == expected
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns and kept.count() == groups
    assert simhash.drop_near_duplicates(no_docs).count() == 0


def test_links_reach_every_pair_within_the_radius(spark):
    base = 0x0F0F1234ABCD9876
    fps = [base] + [base ^ (1 << a) ^ (1 << b) for a, b in ((0, 63), (5, 5), (7, 40), (12, 13))] + [base ^ 0b111 << 20]
    rows = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in set(fps)], "fp bigint")
    roots = {r["node"]: r["root"] for r in components(simhash.links(rows)).collect()}
    assert len(set(roots.values())) == 1 and len(roots) == 3  # the root is not listed; base ^ 0b111 << 20 is three bits away
    try:
        simhash.links(rows, 3)
        raise AssertionError("an odd radius has no half")
    except ValueError:
        pass


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(8, 60)] + [(3, 3)]
    roots = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert roots == {**{i: 100 for i in range(101, 141)}, **{i: 7 for i in range(8, 60)}}
