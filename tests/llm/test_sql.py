"""Queries with SQL: the same rows from both, on the smallest data set and on the odd rows."""

import duckdb
import pytest

from carelake.llm import mixing, queries, rules, urls
from tools.compare import compare, duck

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_its_sql(spark, name):
    line = compare(spark, duck(SMALL), SMALL, name, queries.QUERIES[name], queries.ORACLES[name])
    assert line.startswith("ok"), line


def by_sql(sql, **tables):
    con = duckdb.connect()
    for name, df in tables.items():
        con.register(name, df.toPandas() if hasattr(df, "toPandas") else df)
    return con.execute(sql).fetchall(), [d[0] for d in con.description]


def same(df, sql, **tables):
    want, names = by_sql(sql, **tables)
    got = [tuple(r[n] for n in names) for r in df.collect()]
    order = lambda rows: sorted(rows, key=str)
    assert order(got) == order(want)


def test_rules_on_odd_rows(odd, empty):
    named = odd.where("doc_id is not null").dropDuplicates(["doc_id"])
    same(rules.digest(named), rules.SQL, documents=named.select("doc_id", "text"))
    assert rules.digest(odd).count() == odd.count()
    got = {r.doc_id: r for r in rules.digest(odd).collect()}
    assert got[4].n_words == got[5].n_words == got[6].n_words == 0 and got[4].base_failed and not got[4].kept
    assert got[1].kept and got[8].kept and got[8].n_words == 30_000
    assert rules.digest(empty).count() == 0


def test_repeated_windows_count_the_first_and_overlaps(spark):
    df = spark.createDataFrame([(1, "a b c d a b c x"), (2, "a a a a"), (3, "a b c"), (4, "a b")], "doc_id long, text string")
    assert {r.doc_id: r.n_repeat_words for r in rules.digest(df).collect()} == {1: 6, 2: 4, 3: 0, 4: 0}


def test_policies_and_ablations(odd):
    rows = rules.ledger(odd)
    names = {r.rule: r for r in rules.ablations(rows, "v2").collect()}
    failed = [r.failed for r in rows.collect()]
    assert set(names) == set(rules.RULES)
    for rule, row in names.items():
        bit = rules.bit(rule)
        assert row.n_failed == sum(f & bit > 0 for f in failed) and row.n_only == sum(f == bit for f in failed)
        assert row.n_kept_without == sum(f & ~bit == 0 for f in failed)
    assert rows.where(rules.passes("v1")).count() >= rows.where(rules.passes("v2")).count()


def test_rules_run_no_python(odd):
    plan = rules.digest(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_mix_on_odd_rows(odd, scratch):
    got = mixing.digest(odd, scratch).collect()
    assert len(got) == odd.count()
    sources = {r.doc_id: r for r in got}
    assert sources[4].size == sources[5].size == 0 and sources[4].taken == 0
    assert all(0 <= r.taken <= 3 * r.size and r.target <= 3 * r.source_size for r in got)
    again = mixing.digest(odd, type(scratch)(odd.sparkSession, "again")).collect()
    assert sorted(got, key=str) == sorted(again, key=str)


def test_mix_takes_the_targets(spark, small, scratch):
    mixed = mixing.curriculum(small("documents"), scratch).select("*").toPandas()
    taken = mixed.reads.map(lambda rs: sum(r["words"] for r in rs)).groupby(mixed.source).sum()
    target = mixed.groupby("source").target.first()
    assert ((taken - target).abs() < 1).all()
    assert abs(target.sum() - mixed["size"].sum()) < 1e-6 * mixed["size"].sum()
    # positions rise along a source's demand, in [0, 1]
    reads = sorted((r["position"], r["epoch"]) for s, rs in zip(mixed.source, mixed.reads, strict=True) if s == "src0" for r in rs)
    assert 0 <= reads[0][0] and reads[-1][0] <= 1 and [e for _, e in reads] == sorted(e for _, e in reads)


def test_rising_weight_comes_late(spark, scratch):
    docs = spark.createDataFrame([(i, "w " * 10, s) for s in ("a", "b", "c") for i in range(200)], "doc_id long, text string, source string")
    order = mixing.training_order(mixing.curriculum(docs, scratch, weights=(1, 1, 1))).toPandas()
    mean = order.groupby("source").position.mean()
    assert mean["a"] < mean["b"] < mean["c"] and order.position.is_monotonic_increasing


def test_pipeline_rows_and_blocks_are_in_training_order(spark, scratch):
    import corpus_pipeline

    rows = [(s * 1000 + i, f"t{s} {i} " * (1 + i % 7), "en", "abc"[s], 9) for i in range(300) for s in range(3)] + [
        (0, "t0 0 ", "en", "a", 9), (None, "no id", "en", "b", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    stage = dict(corpus_pipeline.STAGES)
    want = [r.doc_id for r in mixing.training_order(mixing.curriculum(docs, scratch)).collect()]
    assert want != sorted(want, key=str)
    mixed = stage["mix"](spark, docs, SMALL)
    assert [r.doc_id for r in mixed.collect()] == want
    read = scratch.keep(mixed, "mixed")
    for given in (read, mixed):
        blocks = stage["token_blocks"](spark, given, SMALL).orderBy("start").collect()
        assert [r.doc_id for r in blocks] == want


def test_schedules_order_the_documents_of_the_mix(spark, scratch, monkeypatch):
    """What a schedule does to the positions is in the result: the order of the documents follows it."""
    rows = [(s * 1000 + i, f"t{s} {i} " * (1 + i % 7), "abc"[s]) for i in range(300) for s in range(3)] + [
        (None, "no id", "b"), (5000, " ", "a"), (5001, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r for r in mixing.digest(docs, scratch).collect()}
    order = mixing.training_order(mixing.curriculum(docs, scratch_of(scratch, "order"))).collect()
    firsts = {}
    for r in order:
        firsts.setdefault(r.doc_id, r.position)
    assert {i: r.first_position for i, r in got.items() if r.first_position is not None} == firsts
    positions = sorted(firsts.values())
    assert all(r.first_rank == 1 + positions.index(r.first_position) for r in got.values() if r.first_position is not None)
    assert got[5000].first_rank is None and got[5001].first_position is None and got[5000].taken == got[5001].taken == 0
    monkeypatch.setattr(mixing, "SLOPES", (0.0, 0.0, 0.0))
    level = {r.doc_id: r for r in mixing.digest(docs, scratch_of(scratch, "level")).collect()}
    assert [level[i].taken for i in sorted(firsts, key=str)] == [got[i].taken for i in sorted(firsts, key=str)]
    assert any(level[i].first_rank != got[i].first_rank for i in firsts)


def test_mix_matches_its_sql_on_odd_rows(odd, scratch):
    named = odd.where("doc_id is not null").dropDuplicates(["doc_id"])
    same(mixing.digest(named, scratch), mixing.SQL, documents=named.select("doc_id", "text", "source"))


def scratch_of(scratch, name):
    return type(scratch)(scratch.spark, name)


def test_empty_mix(empty, scratch):
    assert mixing.digest(empty, scratch).count() == 0


PAGES = "page_id long, url string, html string, host string, verdict string"


def page(i, url, html=""):
    return (i, url, html, "clash", "clash")


def test_aliases_take_decisions(spark, scratch):
    rows = [
        page(1, "http://a.example.org/es/1"),                                                    # blocked by rule
        page(2, "http://x.net/1", '<link href="http://A.EXAMPLE.org/es/1" rel="canonical">'),    # alias of it
        page(3, "http://y.net/1", '<meta http-equiv="refresh" content="0; url=http://x.net/1">'),  # alias of the alias
        page(4, "http://z.net/1", '<link rel=canonical href="//q.com/fr/2">'),                   # alias of an allowed page
        page(5, "http://z.net/2", '<link rel=canonical href="/1">'),                             # through a relative link
        page(6, "http://both.net/", '<link rel=canonical href="http://a.example.org/es/1"><meta http-equiv=refresh content="1;url=http://q.com/fr/2">'),
        page(7, "http://alone.net/"), page(8, None), page(9, "no scheme"), page(10, "http://example.org/en/12?x=/es/"),
        page(11, "http://notexample.org/es/"), page(12, "http://example.org"), page(7, "http://alone.net/"),
    ]
    got = urls.decided(spark.createDataFrame(rows[:5] + rows[6:], PAGES), urls.rule_table(spark), scratch).collect()
    v = {r.page_id: (r.rule, r.verdict) for r in got}
    assert v[1] == ("example.org/es/", "block") and v[2] == v[3] == (None, "block")
    assert v[4] == v[5] == (None, "allow") and v[7] == v[8] == v[9] == (None, "allow")
    assert v[10] == ("example.org/en/1", "block") and v[11] == ("org/", "allow") and v[12] == (None, "allow")
    assert len(got) == 12
    mixed = urls.decided(spark.createDataFrame(rows, PAGES), urls.rule_table(spark), type(scratch)(spark, "b")).collect()
    v = {r.page_id: r.verdict for r in mixed}
    assert v[1] == "block" and v[2] == v[3] == v[4] == v[6] == "allow"  # an explicit allow decides for those without a rule


def test_no_pages(spark, scratch):
    assert urls.decided(spark.createDataFrame([], PAGES), urls.rule_table(spark), scratch).count() == 0
