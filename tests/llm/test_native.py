"""Operators 4 and 7, the pipeline, and whole queries against DuckDB."""

import math
import random
from pathlib import Path

import duckdb
import pytest

import corpus_pipeline
from textloom.llm import line_dedup, mixing, registry

TABLES = "documents embeddings pages benchmark labels conversations".split()
D = "/root/testdata/sf0.01"


def same(spark, name, sf_dir=D):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    df = registry.queries()[name](spark, sf_dir)
    rel = con.sql(registry.oracle_sql()[name])
    assert sorted(rel.columns) == sorted(df.columns)
    order = [rel.columns.index(c) for c in df.columns]
    key = lambda r: tuple((x is not None, str(type(x)), x if x is not None else 0) for x in r)
    assert sorted((tuple(r) for r in df.collect()), key=key) == sorted((tuple(r[i] for i in order) for r in rel.fetchall()), key=key)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, name):
    same(spark, name)


NAMES = [f"op{n}_" for n in range(1, 11)]


def test_one_query_for_each_operator():
    assert sorted(registry.queries()) == sorted(next(q for q in registry.queries() if q.startswith(n)) for n in NAMES)


def doc(rng, n=40):
    return "\n".join(" ".join(rng.choice(["alpha", "beta", "gamma", "delta", "omega"]) + str(rng.choice("abcdefghijklmnop")) * rng.randrange(1, 6) for _ in range(n // 4)) for _ in range(4))


def test_recurring_lines_go_and_copies_stay(spark):
    rng = random.Random(7)
    passage = " ".join(f"passage{c}word" for c in "abcdefghijklmnopqrstuvwxyz" * 3)
    own = [doc(rng) for _ in range(12)]
    rows = [(i, t if i % 3 else t.replace("\n", f"\n{passage}\n", 1)) for i, t in enumerate(own)]
    rows += [(20 + i, own[1]) for i in range(30)]  # exact copies of one document
    base = own[2].split(" ")
    rows += [(60 + i, " ".join([*base[:i], "edited", *base[i + 1 :]]) if "\n" not in base[i] else own[2]) for i in range(20)]  # near copies of another
    rows += [(100 + i, f"{doc(rng)}\nPage {i} of 17 printed on 2024-01-{i:02d}\n{doc(rng)}") for i in range(8)]
    rows += [(200, None), (201, ""), (202, "\n\n"), (203, passage)]
    df = spark.createDataFrame([(i, t, "x", 1, 1) for i, t in rows], "doc_id long, text string, key string, pos int, ctx int")
    out = line_dedup.drop_recurring_lines(df)
    got = {r.doc_id: r for r in out.collect()}
    assert out.columns == [*df.columns, "__dropped"] and len(got) == len(rows)
    for i, t in rows:
        if i < 12 and i % 3 == 0:
            assert got[i].text == own[i] and got[i].__getitem__("__dropped") == 1
        elif 100 <= i < 200:
            assert "printed" not in got[i].text and got[i]["__dropped"] == 1
        elif i == 203:
            assert got[i].text == "" and got[i]["__dropped"] == 1
        else:
            assert got[i].text == t and got[i]["__dropped"] == 0


def test_copies_and_repeats_protect_no_line(spark):
    rng = random.Random(8)
    notice = "this notice stands in all of them"
    rows = [f"{doc(rng)}\n{notice}" for _ in range(5)]
    rows += [rows[0]] * 60 + ["\n".join([doc(rng), *[notice] * 60])]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {r.doc_id: r for r in line_dedup.drop_recurring_lines(df).collect()}
    for i, t in enumerate(rows):
        assert got[i].text == t.replace(f"\n{notice}", "") and got[i]["__dropped"] == t.count(notice)


def test_lines_recur_whatever_the_vocabulary(spark):
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdefghij") for _ in range(8)) for _ in range(150)]
    text = lambda n: "\n".join(" ".join(rng.choice(words) for _ in range(10)) for _ in range(n))
    block = "\n".join(" ".join(f"block{c}{k}word".replace("0", "zero").replace("1", "one") for c in "abcde") for k in (0, 1))
    rows = [f"{text(3)}\nthis notice stands in all of them" for _ in range(150)]  # few words are the least of a text
    rows += [f"{text(4)}\n{block}" for _ in range(4)]
    base = text(20).split(" ")
    for _ in range(150):  # near copies: 4 % of the words are new
        own = list(base)
        for k in rng.sample([k for k in range(len(own)) if "\n" not in own[k]], 7):
            own[k] = "".join(rng.choice("klmnopqrst") for _ in range(8))
        rows.append(" ".join(own))
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {r.doc_id: r.text for r in line_dedup.drop_recurring_lines(df).collect()}
    for i, t in enumerate(rows):
        assert got[i] == ("\n".join(t.split("\n")[:3]) if i < 150 else "\n".join(t.split("\n")[:4]) if i < 154 else t), i


def test_line_edge_cases(edge_docs, no_docs):
    out = line_dedup.drop_recurring_lines(edge_docs)
    assert out.count() == edge_docs.count() and line_dedup.drop_recurring_lines(no_docs).count() == 0
    assert out.where("doc_id = 4 and text is null and __dropped = 0").count() == 1


def test_mixing_meets_its_target(spark):
    rows = [(i, "big" if i < 9000 else "small" if i < 9990 else "tiny", 1, "x") for i in range(10_000)]
    df = spark.createDataFrame(rows, "doc_id long, source string, copy int, rate string")
    weights = {"big": 1.0, "small": 2.0, "tiny": 1.0}
    out = mixing.mix_sources(df, weights, total=8000).collect()
    n = {s: sum(r.source == s for r in out) for s in weights}
    for s, w in weights.items():
        want = 8000 * w / 4
        assert abs(n[s] - want) < 6 * math.sqrt(want)
    assert [r["__order"] for r in out] == sorted(r["__order"] for r in out)
    tiny = {}
    for r in out:
        if r.source == "tiny":
            tiny.setdefault(r.doc_id, []).append(r["__copy"])
    assert all(sorted(c) == list(range(1, len(c) + 1)) for c in tiny.values()) and len(tiny) == 10  # at a rate of 200
    again = mixing.mix_sources(df.repartition(7), weights, total=8000).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, out))


def test_mixing_follows_poisson(spark):
    df = spark.range(20_000).selectExpr("id doc_id", "'s' source")
    counts = {r.doc_id: r.n for r in mixing.mix_sources(df, {"s": 1.0}, total=30_000).groupBy("doc_id").agg({"*": "count"}).withColumnRenamed("count(1)", "n").collect()}
    for k in range(5):
        want = 20_000 * math.exp(-1.5) * 1.5**k / math.factorial(k)
        have = sum(c == k for c in counts.values()) if k else 20_000 - len(counts)
        assert abs(have - want) < 5 * math.sqrt(want)


def test_mixing_edge_cases(edge_docs, no_docs):
    out = mixing.mix_sources(edge_docs)
    assert out.columns == [*edge_docs.columns, "__copy", "__order"] and out.count() > 0
    assert mixing.mix_sources(no_docs).count() == 0 and mixing.mix_sources(edge_docs, {"nothing": 1.0}).count() == 0
    assert {r.source for r in mixing.mix_sources(edge_docs, {"b": 1.0}).collect()} == {"b"}


def test_pipeline_runs_its_stages(spark):
    docs = spark.read.parquet(f"{D}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_duplicates", "decontamination", "mixing"]
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, before, D)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        n, was = out.count(), before.count()
        assert 0.8 * was < n <= was, name
        before = out
    rows = corpus_pipeline.run(spark, D).collect()
    bench = [r.text.lower() for r in spark.read.parquet(f"{D}/benchmark.parquet").collect()]
    assert rows and not any(b in r.text.lower() for b in bench for r in rows)
    assert len({(r.doc_id, r.copy) for r in rows}) == len(rows)


@pytest.mark.parametrize("stage", [n for n, _ in corpus_pipeline.STAGES])
def test_stage_edge_cases(spark, tmp_path_factory, edge_docs, no_docs, stage):
    d = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame([(1, 1, 0), (2, 1, None), (None, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(1, None), (2, "a passage of the benchmark that is long enough to be found in any text")], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    f = dict(corpus_pipeline.STAGES)[stage]
    assert f(spark, no_docs, d).count() == 0
    out = f(spark, edge_docs, d)
    n = out.count()
    if stage == "mixing":
        assert n > 0 and out.columns[: len(edge_docs.columns)] == edge_docs.columns
        return
    assert out.columns == edge_docs.columns
    gone = {"near_duplicates": 5}.get(stage, 0)  # ids 2, 3, 11 (twice) copy 1, and 8 copies 7
    assert n == edge_docs.count() - gone


def test_nothing_else_imports_the_subpackage():
    top = Path(registry.__file__).parents[1]
    for p in top.rglob("*.py"):
        if "llm" not in p.parts:
            assert "textloom.llm" not in p.read_text(), p
