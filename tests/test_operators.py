"""Metrics, URLs, near duplicates, language votes, tokenizer evaluation, sources, sinks and streams."""

import json
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from textloom.functions import kernels
from textloom.functions import langid as L
from textloom.functions import text as T
from textloom.operators import dedup, langmodels, metrics, tokeval, urls, wordfreq
from textloom.plans import registry
from textloom.sources import jsonl, sinks
from textloom.streaming import incremental


def test_flags(spark):
    texts = ["Lorem Ipsum dolor.", "- item", "• item", "foo", "x {y}.", "Política de privacidad.", "JavaScript.", "Fin...", "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    m = {r.id: r for r in metrics.document_metrics(df, ["id"]).collect()}
    one = lambda i, name: m[i][f"count_{name}"] == 1
    assert one(0, "lorem_ipsum_sentences") and one(1, "sentences_starting_with_bullet") and one(2, "sentences_starting_with_bullet")
    assert one(3, "sentences_without_terminal_punctuation") and one(4, "sentences_with_curly_bracket") and one(5, "sentences_with_legal_phrases")
    assert one(6, "sentences_with_javascript") and one(7, "sentences_ending_with_ellipsis")
    assert len(m) == 10 and m[8].n_sentences == m[9].n_sentences == 0 and m[9].mean_word_length == 0


def test_ratios(spark):
    df = spark.createDataFrame([(1, "ha pe upe"), (2, "ha casa mesa"), (3, "1 2"), (4, "TEMBO tembo")], "id long, text string")
    m = {r.id: r for r in metrics.document_metrics(df, ["id"]).collect()}
    assert m[1].ratio_stopwords_to_non_stopwords == 0 and m[2].ratio_stopwords_to_non_stopwords == 0.5 and m[3].ratio_symbols_to_words == 0
    assert m[4].count_bad_words_occurrences == 2  # longer entries that hold the word do not occur here
    report = metrics.corpus_report(metrics.document_metrics(df.withColumn("corpus", F.lit("c")), ["id", "corpus"]), "corpus").first()
    assert report.documents_count == 4 and report.document_metrics.max_sentences_per_document == 1 and len(report.sentence_metrics) == 23


def test_sentence_kernel_follows_the_profile(spark, monkeypatch):
    """Sums over the kernel's sentences are those of sentence_counts(), and no text is tokenised by expressions."""
    rng = random.Random(7)
    texts = ["Hola. \"Mundo!\" 3.5 x... y\nB. C....\nD", "  ", "", None, "a\x1eb. \x1ec\x1e", "\x1e", "x..\x1d. y. \x1dz", " \x1d q", "İSTANBUL ok. İyi Ñande. ΟΔΟΣ. Σ", "HTTP://x.y/Z?q=1 Fin. http://a.b Otro @Me #Tag a@b.de", "- a. • b. —c", "fin...\x85", "fin.\u2028", "...", "..", "{x} JavaScript Lorem IPSUM. Usa COOKIES aquí", "va'ekue abc123 ÑANDE ñande ñande", "\u3000x。 y! ¿z?) w", "한국어 文字 кот. КОТ 𝒳 😀😀", "TEMBO tembo téviro tembo", "v" * 300 + ". " + "w " * 50, "\x85", "a\r\nb.\r\n", "x.\x0by"]
    texts += ["".join(rng.choice("aZñÑéẽ .!?'’“”…\n\t-1#@_\x1d\x1e\x85\u2028{é̃İ:/") for _ in range(60)) for _ in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, text string").coalesce(1)
    sums = [*kernels.SUMS[1:-1], *kernels.RATIOS]
    spec = metrics.sentence_counts(docs, ["id"]).groupBy("id").agg(F.count("*").alias("n_sentences"), *(F.sum(c).alias(c) for c in sums), F.max("n_words").alias("max_words"), F.min("n_words").alias("min_words"), F.sum(F.col("capital") * F.col("n_words")).alias("capital_words"))
    want = {r.id: r.asDict() for r in spec.collect()}
    bad = metrics.normalized_bad_words(spark)
    want_bad = {r.id: r.b for r in docs.select("id", T.substring_count(T.lookup_form(F.coalesce("text", F.lit(""))), bad).alias("b")).collect()}
    assert sum(want_bad.values()) == 4
    monkeypatch.setattr(T, "tokenize", None)
    for r in metrics.text_counts(docs, ["id"]).collect():
        own = r.asDict()
        assert own.pop("bad") == want_bad[r.id]
        if r.id not in want:
            assert not any(v for k, v in own.items() if k != "id")
        else:
            assert own == pytest.approx(want[r.id]), texts[r.id]
    monkeypatch.setattr(kernels, "SEEN", 10)
    counts = kernels.text_counts([t or "" for t in texts], tuple(metrics.STOPWORDS), tuple(metrics.LEGAL_PHRASES), tuple(bad))
    assert all(counts[c][i] == pytest.approx(want[i][c]) for c in kernels.RATIOS for i in want)
    # equal ids share their sentences' sums; a null id has no sentences, a null that is carried is kept
    twice = spark.createDataFrame([(1, "a", "Uno dos. Tres"), (1, "b", "Cuatro tembo"), (None, "a", "Uno tembo"), (2, None, "Ab")], "id long, s string, text string")
    got = sorted((str(r.id), str(r.s), r.n_sentences, r.max_sentence_length, r.count_bad_words_occurrences) for r in metrics.document_metrics(twice, ["id"], carried=("s",)).collect())
    assert got == [("1", "a", 3, 2, 0), ("1", "b", 3, 2, 1), ("2", "None", 1, 1, 0), ("None", "a", 0, 0, 1)]


def test_reports_read_texts_once(spark):
    """Queries of metrics split and count texts in one kernel pass, without expressions, and shuffle no text."""
    for name in ("corpus_report", "corpus_metric_means", "sentence_word_metrics", "stopword_ratio_by_source"):
        plan = registry.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert plan.count("MapInArrow") == 1 and "regexp" not in plan and "posexplode" not in plan and "Join" not in plan, name


def test_metrics_count_only_what_is_asked(spark):
    """A report of two metrics has their counts made and no others; each count is the same whatever else is counted."""
    plan = registry.queries()["corpus_report"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert all(c in plan for c in ("n_sentences", "n_words", "n_word_chars", "bad")) and not any(c in plan for c in ("n_upper", "char_rep", "no_terminal", "n_stop", "legal"))
    rng = random.Random(8)
    texts = ["", "Lorem ipsum. - JavaScript {x}... Usa COOKIES aquí", "TEMBO ñande http://A.b/Ç. Ok", "İyi ΟΔΟΣ. Σ fin", "a\x1eb. \x1ec\x1e", "x..\x1d. y. \x1dz", "mb’ó téviro. Va'ekue", "• uno 12 uno. fin..."]
    texts += ["".join(rng.choice("aZñÉẽ .!?'’…\n\t-1#_\x1d\x1e\u2028{é̃Σİ:/") for _ in range(40)) for _ in range(200)]
    for some in (texts, [x for x in texts if not set(x) & set("Σİ\x1d")]):  # the second has no text that leaves the tables
        of = lambda only, some=some: kernels.text_counts(some, tuple(metrics.STOPWORDS), tuple(metrics.LEGAL_PHRASES), ("tembo", "teviro", "mbo"), only)
        whole = of(kernels.COUNTS)
        assert all(whole[c].any() for c in kernels.COUNTS) and whole["bad"].sum() == 4
        for c in kernels.COUNTS:
            one = of((c,))
            assert list(one) == [c] and (one[c] == whole[c]).all(), c
        single = [kernels.text_counts([x], tuple(metrics.STOPWORDS), tuple(metrics.LEGAL_PHRASES), ("tembo", "teviro", "mbo")) for x in some]
        assert all(whole[c][i] == pytest.approx(single[i][c][0]) for c in kernels.COUNTS for i in range(len(some)))
    docs = spark.createDataFrame([(1, "Uno DOS. Tres tembo"), (1, "Cuatro"), (None, "tembo"), (2, None)], "id long, text string")
    rows = lambda df: sorted((str(r.id), r.n_sentences, r.mean_word_length, r.min_sentence_length) for r in df.collect())
    asked = metrics.document_metrics(docs, ["id"], only=["min_sentence_length", "mean_word_length"])
    assert asked.columns == ["id", "n_sentences", "min_sentence_length", "mean_word_length"] and rows(asked) == rows(metrics.document_metrics(docs, ["id"]))


def test_word_frequency(spark):
    df = spark.createDataFrame([("b a a",), ("A c",), (None,), ("",)], "text string")
    assert [tuple(r) for r in wordfreq.top_words(df, 2).collect()] == [("a", 3), ("b", 1)]


def test_url_groups(spark):
    df = spark.createDataFrame([("x", "http://a.com/"), ("x", "http://A.com"), ("y", "http://b.com"), ("z", None), ("w", "http://B.com/#q")], "id string, url string")
    u = urls.with_url(df, "id", "url")
    assert {(r.id, tuple(r.others)) for r in urls.url_duplicate_ids(u).collect()} == {("x", ()), ("y", ("w",)), ("w", ("y",))}
    r = urls.url_report(df, u).first()
    assert (r.total_docs, r.total_unique_urls, r.duplicate_groups, r.total_duplicate_documents) == (5, 2, 2, 4)
    rows = [("c", "u", "A"), ("c", "u", "A"), ("d", "u", "A"), ("d", "u", "B"), ("e", "nan", "A"), ("e", "nan", "B")]
    docs = spark.createDataFrame(rows, "corpus string, url string, text string")
    assert [r.corpus for r in urls.corpora_to_ignore(docs, "corpus", "url").collect()] == ["d"]


def near_docs(spark):
    rng = random.Random(1)
    rows = []
    for g in range(12):
        base = [f"{a}{b}" for a, b in zip(rng.choices("klmnpqrst", k=90), rng.choices(["aba", "ebe", "ibi", "obo", "ubu", "aya"], k=90), strict=True)]
        for k in range(4):
            own = list(base)
            for _ in range(k * 2):
                own[rng.randrange(90)] = "zzz" + rng.choice("abc")
            rows.append((g * 10 + k, " ".join(own)))
    rows += [(900, "a b"), (901, "a b"), (902, ""), (903, "12 34"), (904, "?!")]
    return spark.createDataFrame(rows, "id long, text string")


def test_near_duplicates(spark):
    docs = near_docs(spark)
    sets = dedup.shingle_sets(docs, "id")
    rows = {r.id: set(r.h) for r in sets.collect()}
    want = {}
    for a in rows:
        for b in rows:
            j = len(rows[a] & rows[b]) / len(rows[a] | rows[b])
            if a < b and j >= 0.8:
                want[a, b] = j
    pairs = dedup.exact_pairs(sets)
    wide = {(r.id, r.dup_id): r.similarity for r in dedup.expand(pairs, sets).collect()}
    assert {k for k in wide if k[0] < k[1]} == set(want) and all(wide[b, a] == wide[a, b] for a, b in want)
    found = {(r.a, r.b) for r in dedup.minhash_pairs(sets).collect()}
    assert found <= {(r.a, r.b) for r in pairs.collect()} and len(found) >= 0.6 * pairs.count()
    flags = {r.id for r in dedup.near_duplicate_flags(docs, "id", pairs, sets).where("has_duplicate").collect()}
    assert flags == {x for p in want for x in p} and 902 not in flags and {903, 904} <= flags
    assert dedup.shingle_sets(docs, "id", exclude_empty=True).where("id in (903, 904)").count() == 0
    out = dedup.annotate(docs.withColumn("duplicate", F.struct(F.lit(1).alias("other"))), "id", dedup.near_duplicate_flags(docs, "id", pairs, sets))
    assert {r.id for r in out.where("duplicate.minhash.has_duplicate and duplicate.other = 1").collect()} == flags
    r = dedup.dedup_report(sets, None, pairs, 0.8, 128, 5).first()
    assert (r.total_docs, r.verified_docs, r.verified_pairs) == (len(rows), len(flags), len(want))


def test_near_duplicate_pairs_keep_no_table_of_sets(spark, monkeypatch):
    """What pairs write and shuffle are keys and the sets of candidates; the same pairs come by each hashing and order."""
    docs = near_docs(spark)
    want = {tuple(r) for r in dedup.exact_pairs(dedup.shingle_sets(docs, "id")).collect()}
    written = []
    keep = dedup.snapshot
    monkeypatch.setattr(dedup, "snapshot", lambda df, name: written.append(df.columns) or keep(df, name))
    monkeypatch.setattr(dedup, "CELL", 100)  # many cells
    for hashing in ("words", "portable"):
        sets = dedup.shingle_sets(docs, "id", hashing=hashing)
        assert {tuple(r) for r in dedup.exact_pairs(sets, common=dedup.frequent(sets)).collect()} == want
    assert written and all("h" not in columns for columns in written)


def test_kernels_follow_the_profile(spark):
    texts = ["Ñande mba'e rova abc123 x-y a- ab", "MAIL a.b@c.de ok http://x.y/z?q=1 @me #tag fin xhttp://foo bar", "İstanbul ΟΔΟΣ ʼtis “ab”cd e…f g_h _i 12ab", "ab\u0903c abc\u09031 q\u0301r", "", "?!", "w " * 7 + "v" * 300]
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    native = {r.id: r.n for r in dedup.shingle_sets(docs, "id").collect()}
    tokens = {r.id: (r.c, r.t) for r in docs.select("id", T.tokenize(T.canonicalize("text")).alias("c"), T.tokenize("text").alias("t")).collect()}
    for hashing in ("words", "portable"):
        assert {r.id: r.n for r in dedup.shingle_sets(docs, "id", hashing=hashing).collect()} == native
    for k, t in enumerate(texts):
        for (cp, begins), want in ((kernels.canonical([t]), tokens[k][0]), (kernels.lowered(*kernels.joined([t])), tokens[k][1])):
            assert [kernels.characters(cp[a:b]) for a, b in zip(*kernels.spans(cp), strict=True)] == want


def test_signatures_agree_and_parameters(spark):
    sets = dedup.shingle_sets(near_docs(spark), "id").limit(10)
    n = 20
    for r in sets.select(dedup.signature(F.col("h"), n).alias("a"), dedup.signature_udf(n)(F.col("h")).alias("b")).collect():
        assert r.a == r.b
    assert dedup.lsh_params(0.8, 128) == (9, 13) and dedup.lsh_params(0.5, 128) == (25, 5)


def test_signatures_are_exact_remainders():
    p = dedup.PRIME
    rng = random.Random(5)
    ab = [(1, 0), (p - 1, p - 1), (1, p - 1), (p - 1, 0), *dedup.coefficients(30)]
    x = [0, 1, 2, p - 1, p - 2, *(rng.randrange(p) for _ in range(2_000))]
    one = kernels.signatures(np.array(x, np.uint64), np.arange(len(x) + 1), ab, p)
    assert one.tolist() == [[(a * v + b) % p for a, b in ab] for v in x]
    cuts = [0, 0, 700, 701, len(x), len(x)]
    many = kernels.signatures(np.array(x, np.uint64), np.array(cuts), ab, p)
    assert many.tolist() == [one[i:j].min(0).tolist() if j > i else [0] * len(ab) for i, j in zip(cuts, cuts[1:], strict=False)]


def test_buckets_are_made_where_texts_are_read(spark):
    docs = near_docs(spark)
    sets = dedup.shingle_sets(docs, "id", hashing="portable")
    want = {r.id: r for r in dedup.bucketed(sets).collect()}
    got = {r.id: r for r in dedup.bucketed_texts(docs, "id").collect()}
    assert got.keys() == want.keys() and all((got[i].n, got[i].buckets) == (want[i].n, want[i].buckets) for i in want)
    groups = lambda rows: {frozenset(i for i in rows if (rows[i].k1, rows[i].k2) == (r.k1, r.k2)) for r in rows.values()}
    assert groups(got) == groups(want) and len(groups(got)) < len(got)
    plan = registry.queries()["minhash_lsh_index"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "ArrowEvalPython" not in plan


def test_vote_and_models(spark):
    with pytest.raises(ValueError):
        L.vote(F.lit(1), F.lit(1), F.lit(1), k=0)
    with pytest.raises(ValueError):
        langmodels.LanguageIdentifier().identify(spark.range(1), k=0)
    docs = spark.createDataFrame([(i, "the cat and the dog here", "en") if i % 2 else (i, "der hund und die katze hier", "de") for i in range(20)], "id long, text string, lang string")
    nb = langmodels.NaiveBayes.train(docs)
    lid = langmodels.LanguageIdentifier(nb, nb, None, F.create_map(F.lit("de"), F.lit("deu")))
    got = lid.identify(docs, k=1).select("lang", "prediction.*").distinct().collect()
    assert {(r.lang, r.top.code, r.source) for r in got} == {("en", "en", "glotlid"), ("de", "deu", "glotlid")}
    raw = lid.identify(docs.limit(1), k=2, raw_output=True).first().prediction
    assert len(raw.glotlid) == 2 and raw.openlid is None and raw.glotlid[0].conf >= raw.glotlid[1].conf
    assert langmodels.LanguageIdentifier(langmodels.fasttext_model("/none")).identify(docs, k=1).where("prediction is not null").count() == 0


def test_language_models_read_texts_once(spark, monkeypatch):
    """Counts and features of the kernel are those of the profile's tokens, and three models cost one pass each way."""
    monkeypatch.setattr(langmodels, "HELD", 3)  # several parts of the sums
    rows = [(1, "Ñande mba'e rova abc123 x-y ab ABC", "gn"), (2, "İstanbul ΟΔΟΣ a@b.de http://x.y/z ok @me 한국어문 ab", "tr"), (3, "abcd abce abcf xyz", "gn"), (4, "", "gn"), (5, None, "gn"), (6, "abcd", None), (7, "12 ?!", "tr"), (8, "zzz", "gn")]
    docs = spark.createDataFrame(rows, "id long, text string, lang string")
    for n in (1, 2, 4, 7):
        tokens = docs.where("lang is not null").select("lang", F.explode(T.tokenize("text")).alias("t"))
        want = {(r.lang, r.f, r.c) for r in tokens.groupBy("lang", F.substring("t", 1, n).alias("f")).agg(F.count("*").alias("c")).collect()}
        assert {tuple(r) for r in langmodels.beginning_counts(docs, n).collect()} == want
    models = langmodels.NaiveBayes.train_all(docs, (2, 3, 4))
    assert [m.table for m in models] == [langmodels.NaiveBayes.train(docs, n=n).table for n in (2, 3, 4)]
    out = langmodels.LanguageIdentifier(*langmodels.together(models)).identify(docs, raw_output=True)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "regexp_extract_all" not in plan
    got = {r.id: r.prediction for r in out.collect()}
    for i, text, _ in rows:
        own = [] if text is None else docs.where(F.col("id") == i).select(T.tokenize("text").alias("t")).first().t
        for m, p in zip(models, (got[i].glotlid, got[i].fasttext, got[i].openlid), strict=True):
            if not own:
                assert p is None
                continue
            s = {x: sum(m.table[x].get(t[: m.n], 0) for t in own) for x in m.table}
            total = sum(math.exp(v - max(s.values())) for v in s.values())
            assert {c.code: c.conf for c in p} == pytest.approx({x: math.exp(v - max(s.values())) / total for x, v in s.items()})


def test_collisions(spark):
    df = spark.createDataFrame([(["__label__x_A", "y_B", "x"], [0.5, 0.3, 0.1])], "l array<string>, c array<double>")
    none = F.lit(None).cast("map<string,string>")
    for how, want in [("last", [("y", 0.3), ("x", 0.1)]), ("sum", [("x", 0.6), ("y", 0.3)]), ("max", [("x", 0.5), ("y", 0.3)])]:
        assert [tuple(p) for p in df.select(L.process_predictions(F.col("l"), F.col("c"), none, how).alias("p")).first().p] == want


def test_tokenizer_evaluation(spark):
    df = spark.createDataFrame([(["Ñan", "de", " re", "ko", "x"], ["Ñande", "rekox"])], "t array<string>, w array<string>")
    r = df.select(tokeval.continued_words(F.col("t")).alias("a"), tokeval.continued_words_aligned(F.array(*map(F.lit, ("Ñan", "de", "reko", "x"))), F.col("w")).alias("b"), tokeval.fertility(F.lit(0), F.lit(3)).alias("f")).first()
    assert (r.a, r.b, r.f) == (2, 2, None)
    docs = spark.createDataFrame([(1, "abab c"), (2, "")], "id long, text string")
    long = tokeval.run_experiment(docs, {"toy": tokeval.greedy_tokenizer(["ab"])}, F.size(tokeval.segment(F.col("text"))), "id")
    s = tokeval.fertility_summary(long, ["toy"]).first()
    assert (s.type, s.total_words, s.total_tokens, s.fertility_score) == ("gn", 2, 4, 2.0)


def test_continued_words_of_whole_texts(spark, tmp_path):
    rng = random.Random(4)
    texts = [None, "", " ", "ab", *(rng.choice(["", " "]) + " ".join("".join(rng.choice("theringquanó.") for _ in range(rng.randrange(1, 9))) for _ in range(n)) for n in (1, 29, 31, 60, 3000))]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r.n_continued for r in registry.queries()["continued_words_whole"](spark, str(tmp_path)).collect()}
    for i, text in enumerate(texts):
        n, new = 0, True
        for word in [] if text is None else re.split(r"\s+", text, flags=re.A):
            for t in re.findall(" ?(?:tion|ing|the|an|ch|en|er|es|ou|qu|é|ó|.)", f" {word}", re.S):
                new = not (new and not t.startswith(" "))
                n += not new
        assert got[i] == (None if text is None else n), i


def test_sources_and_sinks(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "a.jsonl").write_text("\n".join([json.dumps({"text": "uno", "url": "http://x.y", "k": 1}), "", "  ", json.dumps({"text": 5, "sentence": "dos"}), json.dumps({"content": "tres"})]))
    (raw / "a_b.jsonl").write_text(json.dumps({"text": "", "sentence": "x"}) + "\n")
    (raw / "skip.txt").write_text("no")
    docs = jsonl.assign_ids(jsonl.with_text(jsonl.read_corpora(spark, str(raw), exact_types=True)))
    assert {(r.id, r.text) for r in docs.collect()} == {("a_0", "uno"), ("a_1", "dos"), ("a_2", "tres"), ("a_b_0", "")}
    assert json.loads(docs.where("id = 'a_0'").first().record)["k"] == 1
    assert jsonl.non_empty(docs).count() == 3 and jsonl.init_flags(docs).where("not duplicate.minhash.has_duplicate").count() == 4
    with pytest.raises(Exception, match="blank line"):
        jsonl.read_corpora(spark, str(raw), on_blank="error").count()
    (raw / "bad.jsonl").write_text("{oops\n")
    with pytest.raises(Exception):
        jsonl.read_corpora(spark, str(raw)).collect()
    sinks.write_corpora(docs, str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out")).where("corpus = 'a'").count() == 3
    sinks.write_pairs(spark.range(5), str(tmp_path / "pairs"), batch=2)
    assert len(list((tmp_path / "pairs").glob("part-*"))) >= 3
    (tmp_path / "w.txt").write_text("# c\nHa\n\n pe \nha\n")
    assert jsonl.read_words(spark, str(tmp_path / "w.txt")) == ["ha", "pe", "ha"]
    (tmp_path / "m.csv").write_text("M_Id,I_Id,I_Status\nzho,nan,A\ngrn,gug,A\n")
    codes = jsonl.read_macro_codes(spark, str(tmp_path / "m.csv"))
    row = spark.range(1).select(L.macro_code(F.lit("nan"), jsonl.macro_map(codes)).alias("a"), L.macro_code(F.lit("spa"), jsonl.macro_map(codes)).alias("b")).first()
    assert (row.a, row.b) == ("zho", "spa")
    (tmp_path / "e.csv").write_text('text,num_words_punct_spacy\n"a ""b""\nc",3\n')
    assert [tuple(r) for r in jsonl.read_experiment(spark, str(tmp_path / "e.csv")).collect()] == [('a "b"\nc', 3)]
    sinks.concat_lines(spark, str(raw), str(tmp_path / "all"))
    assert spark.read.text(str(tmp_path / "all")).count() == 6


def test_streams(spark, tmp_path):
    (tmp_path / "in").mkdir()
    rows = [{"id": i, "url": "http://a.com/" + "/" * (i % 2), "text": "the same words in every text of this little batch here", "ts": "2024-01-01T00:00:00"} for i in range(3)]
    (tmp_path / "in" / "x.json").write_text("\n".join(map(json.dumps, rows)))
    schema = "id long, url string, text string, ts timestamp"
    stream = incremental.stream_documents(spark, str(tmp_path / "in"), schema)
    q = incremental.drop_repeated_urls(stream, "url", "ts").writeStream.format("memory").queryName("once").option("checkpointLocation", str(tmp_path / "c1")).start()
    q.processAllAvailable()
    q.stop()
    assert spark.table("once").count() == 1
    write = incremental.near_duplicate_writer(str(tmp_path / "index"), str(tmp_path / "pairs"), "id")
    q = stream.writeStream.foreachBatch(write).option("checkpointLocation", str(tmp_path / "c2")).start()
    q.processAllAvailable()
    (tmp_path / "in" / "y.json").write_text(json.dumps(rows[0] | {"id": 50}))
    q.processAllAvailable()
    q.stop()
    assert {(r.a, r.b) for r in spark.read.parquet(str(tmp_path / "pairs")).collect()} == {(0, 50)}
