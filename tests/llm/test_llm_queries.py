"""Registered corpus queries against their SQL, and the pipeline against its parts."""

import itertools
import math
import random

import duckdb
import pytest
from compare import DATA, assert_same

import corpus_pipeline
from sensorloom.llm import mixing, queries, sharding, toxicity
from sensorloom.llm.common import cut


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_matches_sql(spark, name):
    assert_same(spark, queries.QUERIES[name], queries.SQL[name])


def test_thirteen_queries():
    assert [n.split("_")[0] for n in queries.QUERIES] == [f"op{i}" for i in range(1, 14)]


def test_pipeline_keeps_clean_documents_whole(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns, kept = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES[:3]:
        after = stage(spark, kept, DATA)
        assert after.columns == columns
        assert after.join(kept, columns, "left_anti").count() == 0, name
        kept = cut(after)
    copies = docs.selectExpr("md5(text) as t").join(kept.selectExpr("md5(text) as t"), "t", "left_anti").count()
    assert 0 < kept.count() < docs.count() and copies < docs.count() / 2
    mixed = corpus_pipeline.STAGES[3][1](spark, kept, DATA)
    assert mixed.columns == columns and mixed.join(kept, "doc_id", "left_anti").count() == 0
    sharded = corpus_pipeline.STAGES[4][1](spark, mixed, DATA)
    assert sharded.count() == mixed.count()


def odd_documents(spark, tmp_path):
    """A table folder whose documents hold nulls, repeats, a very long text and columns that clash, beside labels and benchmark."""
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{DATA}/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))
    item = spark.read.parquet(f"{DATA}/benchmark.parquet").first().text
    rows = [(i, f"plain words number {i} of a text that nobody repeats anywhere {i * 7}", "en", "ab"[i % 2], 5) for i in range(40)]
    rows += [(0, rows[0][1], "en", "a", 5), (100, rows[1][1], "en", "a", 5), (None, "no id at all", None, None, None), (101, None, None, "a", None), (102, "", None, None, 0), (103, "long word " * 60_000, "en", "b", 1), (104, f"so {item} it goes", "en", "b", 1), (105, "you idiot moron scum and pathetic loser", "en", "b", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    clash = {"tox_score": "x", "_copies": "y", "set": "z", "_digest": "w", "label": "v"}
    for c, v in clash.items():
        df = df.selectExpr("*", f"'{v}' as `{c}`")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    return str(tmp_path), df


def test_pipeline_of_odd_documents(spark, tmp_path):
    where, docs = odd_documents(spark, tmp_path)
    kept = docs
    want = {None, 101, 102, 103, *range(40)}
    for (name, stage), gone in zip(corpus_pipeline.STAGES, ({105}, {100}, {104}, set(), set()), strict=True):
        after = cut(stage(spark, kept, where))
        ids = {r.doc_id for r in after.select("doc_id").collect()}
        if name in ("toxicity", "jaccard_join", "decontamination"):
            assert after.columns == docs.columns and not ids & gone, name
        kept = after
        if name == "decontamination":
            assert ids == want and kept.count() == len(want)
    assert {"shard", "shard_depth", "shard_bytes"} <= set(kept.columns) and set(docs.columns) <= set(kept.columns)
    whole = corpus_pipeline.run(spark, where)
    assert sorted(str(tuple(r)) for r in whole.collect()) == sorted(str(tuple(r)) for r in kept.select(*whole.columns).collect())


def test_pipeline_of_no_documents(spark, tmp_path):
    where, docs = odd_documents(spark, tmp_path)
    none = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        none = cut(stage(spark, none, where))
        assert none.count() == 0, name


def by_brute_force(docs, items, limit):
    """The pipeline's rows ``(doc_id, shard, shard_depth, shard_bytes)`` by plain loops and SQL, of plain lower-case texts without labels."""
    lexicon = toxicity.Lexicon()

    def toxic(text):
        total = toxicity.SEED_WEIGHT * len(set(text.split()) & set(toxicity.SEED))
        a, b, c = lexicon.coef
        return 1 / (1 + math.exp(-(a + b * math.log1p(total) + c * math.log1p(1000 * total / (len(text) + 202))))) >= 0.5

    shingles = lambda text: {tuple(text.split()[i : i + 5]) for i in range(max(1, len(text.split()) - 4))}
    kept = {i: (text, source) for i, text, source in docs if not toxic(text)}
    sets, lead = {i: shingles(t) for i, (t, _) in kept.items()}, {i: i for i in kept}
    for a, b in itertools.combinations(kept, 2):
        if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
            low, high = sorted((lead[a], lead[b]))
            lead = {i: low if x == high else x for i, x in lead.items()}
    kept = {i: v for i, v in kept.items() if lead[i] == i}
    kept = {i: v for i, v in kept.items() if not any(len(shingles(x) & sets[i]) >= 0.8 * len(shingles(x)) for x in items)}
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar, source varchar)")
    con.executemany("insert into documents values (?, ?, ?)", [(i, *v) for i, v in kept.items()])
    taken = {r[0]: r[4] // r[1] for r in con.sql(f"select doc_id, size, source_size, target, taken from ({mixing.OP6_SQL})").fetchall()}
    con.execute("delete from documents")
    con.executemany("insert into documents values (?, ?, ?)", [(i, *v) for i, v in kept.items() for _ in range(taken[i])])
    sql = sharding.OP7_SQL.replace(str(4 << 20), str(limit))
    found = con.sql(f"select distinct doc_id, shard, shard_depth, shard_bytes from ({sql})").fetchall()
    return sorted(r for r in found for _ in range(taken[r[0]]))


def test_pipeline_matches_brute_force(spark, tmp_path, monkeypatch):
    rng = random.Random(11)
    vocabulary = [a + b + c + d for a in "bdgkl" for b in "aeo" for c in "mnrst" for d in "aiu"]
    plain = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    source = lambda: rng.choice(["a", "a", "a", "b", "c", None])
    base, items = [plain(rng.randrange(60, 90)) for _ in range(40)], [plain(40) for _ in range(3)]
    docs = [(i, t, source()) for i, t in enumerate(base)]
    for i, t in enumerate(base[:10]):
        words = t.split()
        far = [w if k % 13 else "zz" for k, w in enumerate(words)]
        docs += [(100 + i, " ".join([*words[:-1], "ending"]), source()), (200 + i, " ".join(far), source()), (300 + i, t, source())]
    docs += [(400 + i, plain(20) + " " + " ".join(rng.sample(list(toxicity.SEED), 6)), source()) for i in range(5)]
    docs += [(500 + i, f"{plain(20)} {x} {plain(20)}", source()) for i, x in enumerate(items)]
    rng.shuffle(docs)
    limit = 6000
    monkeypatch.setattr(sharding, "LIMIT", limit)
    want = by_brute_force(docs, items, limit)
    spark.createDataFrame(docs, "doc_id long, text string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).select("doc_id", "shard", "shard_depth", "shard_bytes").collect()
    assert sorted(tuple(r) for r in got) == want
    ids = {w[0] for w in want}
    assert not ids & set(range(400, 600)) and not ids & {*range(100, 110), *range(300, 310)} and len(ids & set(range(200, 210))) > 5 and len({w[1] for w in want}) > 3
