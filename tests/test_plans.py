"""Layer 4: plan checks — semi joins where only presence matters, no cartesian
products or Python evaluation anywhere, pruned scans and pushed filters."""

import re

import pytest
from pyspark.sql import functions as F

from locations import SF001
from scholarmetrics.functions.predicates import papers_of_year
from scholarmetrics.operators import links as J
from scholarmetrics.operators.skew import hot_keys, hot_profile, skew_join
from scholarmetrics.plans.catalog import QUERIES
from scholarmetrics.plans.inspect import forbidden_operators, plan_text

# The model queries fit when they are built; their returned frames are tiny.
PLANNED = sorted(
    n for n in QUERIES if not n.startswith(("linear_model", "mse_by_budget")) and not n.endswith("_model")
)


@pytest.mark.parametrize("name", PLANNED)
def test_no_forbidden_operators(spark, name):
    df = QUERIES[name](spark, SF001)
    assert forbidden_operators(df) == []


def test_semi_joins(sf001_tables):
    t = sf001_tables
    p = papers_of_year(t.papers, 1997)
    assert "LeftSemi" in plan_text(J.citations_to(t.paper_references, p))
    assert "LeftSemi" in plan_text(J.authorships_of(t.paper_authors, p))


def test_edge_scan_is_pruned(spark):
    df = QUERIES["citation_counts"](spark, SF001)
    text = plan_text(df)
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", text)
    assert schemas == ["struct<l_partkey:bigint>"]
    # partial aggregate before the shuffle (map-side combine)
    assert "partial_count" in text


def test_filters_reach_scan(spark):
    text = plan_text(QUERIES["papers_with_counts"](spark, SF001))
    assert re.search(r"PushedFilters: \[IsNotNull\(o_orderdate\)", text)
    text = plan_text(QUERIES["papers_in_field"](spark, SF001))
    assert "EqualTo(p_brand,Brand#2)" in text


def test_merge_is_one_shuffle_by_paper(spark):
    """X9 in all its parts (kept counts, kept links, the merge): at most 13 scans and 8
    shuffles, and a single one by paper id in the merge itself."""
    from scholarmetrics.plans import workflows
    from scholarmetrics.sources.tables import materialize

    kept = []

    def noted(df, *args):
        kept.append(plan_text(df, "simple"))
        return materialize(df, *args)

    old, workflows.materialize = workflows.materialize, noted
    try:
        merged = QUERIES["merged_features"](spark, SF001)
    finally:
        workflows.materialize = old
    texts = [*kept, plan_text(merged, "simple")]
    scans = [len(re.findall(r"FileScan|Scan ExistingRDD", t)) for t in texts]
    shuffles = [len(re.findall(r"(?<!Broadcast)Exchange hash", t)) for t in texts]
    assert len(kept) == 2 and sum(scans) <= 13 and sum(shuffles) <= 8
    assert len(re.findall(r"Exchange hashpartitioning\(paper_id", texts[-1])) == 1
    assert "CartesianProduct" not in texts[-1]


def test_merge_tagged_keeps_papers_without_rows(spark):
    from scholarmetrics.operators.features import merge_tagged

    base = spark.createDataFrame([("1", 3), ("2", 1)], "paper_id string, nb_citations long")
    a = spark.createDataFrame([("1", 2.0), ("1", 4.0), ("9", 7.0)], "paper_id string, a double")
    b = spark.createDataFrame([("2", None)], "paper_id string, b double")
    got = {r.paper_id: (r.nb_citations, r.a, r.b) for r in merge_tagged(base, {"a": a, "b": b}).collect()}
    assert got == {"1": (3.0, 3.0, None), "2": (1.0, None, None)}


def test_bucketed_tables_meet_without_an_exchange(spark):
    """S3: join and aggregates by paper id on bucketed copies, in this session and as a
    later session would read them, also where nothing may be broadcast."""
    from scholarmetrics.plans import catalog
    from scholarmetrics.sources.tables import read_bucketed

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", None)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tables = catalog.bucketed_tables(spark, SF001)
        again = {}
        for n, df in tables.items():
            files = df.inputFiles()
            again[n] = read_bucketed(spark, files[0].rsplit("/", 1)[0], "paper_id", 8)
            assert len(files) <= 8  # one file a bucket
        for t in (tables, again):
            out = catalog.profile_of(**t)
            assert "Exchange" not in plan_text(out, "simple") and out.count() == 15000
        plain = catalog.profile_of(**{n: spark.read.parquet(*df.inputFiles()) for n, df in tables.items()})
        assert "Exchange hashpartitioning(paper_id" in plan_text(plain, "simple")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old) if old else spark.conf.unset(
            "spark.sql.autoBroadcastJoinThreshold"
        )


def test_rows_and_rejects_come_from_one_scan(spark, tmp_path):
    from scholarmetrics.plans import catalog
    from scholarmetrics.schemas import PAPERS
    from scholarmetrics.sources.tsv import count_rejects, observe_rejects, parse_tagged, write_with_rejects

    path = str(tmp_path / "lines")
    catalog.damaged_lines(spark, SF001).write.text(path)
    tagged = parse_tagged(spark.read.text(path), PAPERS)
    counted = count_rejects(tagged)
    assert plan_text(counted, "simple").count("FileScan") == 1
    by_reason = {r.reason: r.nb_lines for r in counted.collect()}
    assert set(by_reason) == {"", "year", "short line"}
    # the counters of the rejects come with the job that reads the rows
    rows, seen = observe_rejects(tagged, "one_scan")
    assert plan_text(rows, "simple").count("FileScan") == 1
    assert rows.count() == by_reason[""] + by_reason["year"]
    total = {"nb_lines": 15000, "nb_short": by_reason["short line"], "nb_unparsed": by_reason["year"]}
    assert seen.get == total
    # both are written by one job
    out = str(tmp_path / "both")
    assert _jobs(spark, "write-both", lambda: write_with_rejects(tagged, out)) == 1
    written = spark.read.parquet(out)
    assert written.filter("part = 'rows'").count() == rows.count()
    assert written.filter("part = 'rejects'").count() == total["nb_short"] + total["nb_unparsed"]


def _skewed(spark, n=30000):
    """A probe whose key 'hot' holds a third of the rows, and a unique lookup."""
    probe = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("paper_id"),
        F.col("id").alias("v"),
    )
    lookup = spark.range(n).select(F.col("id").cast("string").alias("paper_id"), F.lit(1).alias("nb"))
    lookup = lookup.union(spark.createDataFrame([("hot", 5), (None, 9)], "paper_id string, nb int"))
    return probe, lookup.groupBy("paper_id").agg(F.max("nb").alias("nb"))


def _jobs(spark, group, run):
    """Jobs that ``run`` starts."""
    sc = spark.sparkContext
    sc.setJobGroup(group, group)
    try:
        run()
        return len(sc.statusTracker().getJobIdsForGroup(group))
    finally:
        sc.setJobGroup("tests", "tests")


def test_hot_keys_detected(spark):
    probe, _ = _skewed(spark)
    found = []
    assert _jobs(spark, "hot-first", lambda: found.append(hot_keys(probe, "paper_id", min_share=0.05))) >= 1
    # the same probe again (rebuilt, same plan) is answered from the memo
    again, _ = _skewed(spark)
    assert _jobs(spark, "hot-again", lambda: found.append(hot_keys(again, "paper_id", min_share=0.05))) == 0
    assert found == [["hot"], ["hot"]]
    spark.conf.set("scholarmetrics.skewSplit", "off")
    try:
        assert hot_keys(probe, "paper_id", min_share=0.05) == []
    finally:
        spark.conf.unset("scholarmetrics.skewSplit")


def test_profile_covers_all_keys_of_a_table_in_one_job(spark):
    table = spark.range(60000).select(
        F.when(F.col("id") % 3 == 0, "p").otherwise(F.col("id").cast("string")).alias("paper_id"),
        F.when(F.col("id") % 4 == 0, "a").otherwise(F.col("id").cast("string")).alias("author_id"),
        F.col("id").cast("string").alias("other"),
    )
    profile = hot_profile(table, min_share=0.05)
    assert {c: list(k) for c, k in profile.items()} == {"paper_id": ["p"], "author_id": ["a"]}
    assert abs(profile["paper_id"]["p"] - 1 / 3) < 0.06 and abs(profile["author_id"]["a"] - 1 / 4) < 0.06
    assert _jobs(spark, "other-key", lambda: hot_profile(table, min_share=0.05)) == 0


def test_share_of_a_hot_key_is_also_bounded_in_bytes(spark, sf001_tables):
    from scholarmetrics.operators.skew import MAX_HOT_KEYS, default_min_share

    name = "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes"
    by_factor = default_min_share(sf001_tables.paper_references)
    spark.conf.set(name, "1k")
    try:
        assert 1 / MAX_HOT_KEYS <= default_min_share(sf001_tables.paper_references) < by_factor
    finally:
        spark.conf.unset(name)


@pytest.mark.parametrize("how", ["left", "inner", "left_semi"])
@pytest.mark.parametrize("unique", [True, False])
def test_skew_join_is_exact(spark, how, unique):
    probe, lookup = _skewed(spark)
    probe = probe.union(spark.createDataFrame([(None, -1)], "paper_id string, v bigint"))
    if not unique:  # a build side that repeats keys multiplies rows as a plain join does
        lookup = lookup.union(lookup.filter("paper_id IN ('hot', '1')"))
    split = skew_join(probe, lookup, "paper_id", how, hot={"hot": 1 / 3, "nowhere": 0.1})
    plain = probe.join(lookup, "paper_id", how)
    assert split.columns == plain.columns
    assert split.exceptAll(plain).count() == 0 and plain.exceptAll(split).count() == 0
    # one pass over either side, nothing broadcast by a hint
    plans = [df._jdf.queryExecution().optimizedPlan().toString() for df in (split, plain)]
    assert plans[0].count("Union") == plans[1].count("Union") and "strategy=broadcast" not in plans[0]


def test_non_unique_build_side_is_never_broadcast_unchecked(spark):
    """J5 on a papers table that repeats an id: rows multiply as in any inner join,
    and the plan forces no broadcast."""
    papers = spark.createDataFrame([("1", 1999, "v"), ("1", 1999, "w"), ("2", 2000, "")], "paper_id string, year int, venue_key string")
    edges = spark.createDataFrame([("9", "1"), ("8", "1"), ("7", "2")], "citing_id string, cited_id string")
    out = J.paper_citation_pairs(papers, edges)
    assert sorted((r.paper_id, r.venue_key, r.citing_id) for r in out.collect()) == [
        ("1", "v", "8"), ("1", "v", "9"), ("1", "w", "8"), ("1", "w", "9"), ("2", "", "7")
    ]
    assert "strategy=broadcast" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert J.paper_citation_pairs(papers, edges, ["venue_key"]).columns == ["paper_id", "venue_key", "citing_id"]


def test_lookup_salts_hot_keys_by_itself(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        probe, lookup = _skewed(spark)
        out = J.lookup_default(probe, lookup, "paper_id", "nb", 0)
        assert "__salt" in plan_text(out)
        assert out.filter("paper_id = 'hot'").agg(F.sum("nb")).first()[0] == 5 * 10000
        assert out.count() == 30000
        spark.conf.set("scholarmetrics.skewSplit", "off")
        assert "__salt" not in plan_text(J.lookup_default(probe, lookup, "paper_id", "nb", 0))
    finally:
        spark.conf.unset("scholarmetrics.skewSplit")
        spark.conf.set("spark.sql.shuffle.partitions", old)


@pytest.mark.parametrize("name", ["merged_features_by_parts", "all_weights", "paper_field_sum", "paper_author_feature"])
def test_one_profile_per_base_table_and_no_more_scans(spark, name, split_conf):
    """Building a query profiles each base table once, and the salted plan scans
    ``lineitem`` no more often than the plain one."""
    from scholarmetrics.operators import skew

    def scans():
        text = QUERIES[name](spark, SF001)._jdf.queryExecution().optimizedPlan().toString()
        return text.count("l_orderkey#") and len(re.findall(r"Relation \[l_orderkey", text))

    skew._memo.clear()
    salted = scans()
    assert len(skew._memo) <= 3  # paper_authors, paper_keywords, papers
    spark.conf.set("scholarmetrics.skewSplit", "off")
    try:
        assert salted == scans()
    finally:
        spark.conf.unset("scholarmetrics.skewSplit")


def test_year_semi_joins_get_runtime_bloom_filter(spark):
    """When the edge/link scans are large (threshold lowered here to stand in
    for the full dump) and the join is a shuffle join, Spark injects a bloom
    filter built from the year's papers into the big scan, so only rows of
    that year's papers reach the shuffle.  The sum weights join only the
    links of cited papers (inner), so they get the filter too."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1k",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        for name in (
            "citations_to_year", "papers_with_counts", "authorships_of_year",
            "author_weights_position", "affiliation_weights", "field_weights",
        ):
            text = plan_text(QUERIES[name](spark, SF001), "simple")
            assert "might_contain" in text, name
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_gap_count_reuses_join_partitioning(spark):
    """E2 counts on the cited id right after the join on the cited id: the
    aggregate adds no shuffle of its own (two edge joins, no third exchange
    for the count)."""
    import re

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", None)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lp = QUERIES["gap_counts_cited"](spark, SF001)._jdf.queryExecution().optimizedPlan().toString()
        assert sorted(re.findall(r"Join (\w+)", lp)) == ["Inner", "Inner", "LeftOuter"]
        text = plan_text(QUERIES["gap_counts_cited"](spark, SF001), "simple")
        # between the final count and its partial count there is no Exchange
        final_to_partial = text.split("functions=[count(1)]", 1)[1].split("functions=[partial_count(1)]", 1)[0]
        assert "Exchange" not in final_to_partial
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old) if old else spark.conf.unset(
            "spark.sql.autoBroadcastJoinThreshold"
        )


def test_shuffle_sizing_follows_input_size(spark, sf001_tables):
    from scholarmetrics.plans.sizing import suggested_shuffle_partitions

    t = sf001_tables
    small = suggested_shuffle_partitions([t.paper_references])
    assert small == 200  # the floor: sf0.01 is a few MB
    # 1 KB per partition stands in for a large input against a normal target
    big = suggested_shuffle_partitions([t.paper_references, t.papers], target_bytes=1024, maximum=10**9)
    assert big > 1000
    assert suggested_shuffle_partitions([t.paper_references], target_bytes=1024, maximum=1000) == 1000
    # no bound unless one is asked for
    assert suggested_shuffle_partitions([t.paper_references], target_bytes=1) > 1_000_000


@pytest.mark.parametrize("name", PLANNED)
def test_no_forced_broadcast(spark, name):
    """No query forces a broadcast: every broadcast in a plan is AQE's choice from
    measured sizes."""
    plan = QUERIES[name](spark, SF001)._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" not in plan


def test_merge_reads_only_cited_links(spark, sf001_tables):
    """X9 uses positive weights only, so its entity weights come from the links of cited
    papers alone: each link table is joined to them once, no zero-weight union."""
    from scholarmetrics.plans.workflows import YearFeatures

    links = YearFeatures(sf001_tables, 1997).cited_links
    joins = re.findall(r"Join (\w+)", links._jdf.queryExecution().optimizedPlan().toString())
    assert set(joins) <= {"Inner", "LeftOuter", "LeftSemi"}
    assert links.filter("kind = 'author'").count() < sf001_tables.paper_authors.count() / 2
    # the weight query itself keeps zero-weight authors (union with all links)
    assert "Union" in plan_text(QUERIES["author_weights_position"](spark, SF001))


def test_split_join_evens_out_partitions(spark, sf001_tables):
    """A third of the link rows get one paper id (derived from the fixture's
    links).  A plain shuffle join puts that third into one partition; the
    split join keeps every partition far below it, with identical rows."""
    from scholarmetrics.plans.workflows import YearFeatures

    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        counts = YearFeatures(sf001_tables, 1997).counts.filter("nb_citations > 0")
        hot_paper = counts.orderBy("paper_id").first().paper_id
        links = sf001_tables.paper_authors.select(
            F.when(F.abs(F.hash("paper_id", "author_id", "author_seq")) % 3 == 0, F.lit(hot_paper))
            .otherwise(F.col("paper_id")).alias("paper_id"),
            "author_id",
        )
        build = counts.select("paper_id", "nb_citations")
        keys = hot_profile(links, ["paper_id"], min_share=0.05)["paper_id"]
        assert list(keys) == [hot_paper]

        def largest_share(df):
            sizes = [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]
            return max(sizes) / sum(sizes)

        plain = links.join(build, "paper_id", "left")
        split = skew_join(links, build, "paper_id", "left", hot=keys)
        assert largest_share(plain) > 0.3
        assert largest_share(split) < 0.15
        assert split.exceptAll(plain).count() == 0 and plain.exceptAll(split).count() == 0
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_detection_on_base_table(spark):
    """A probe derived from a base table (here a filtered subset) is salted by the
    hot keys of the base table; the rows stay exact and the base table's profile is
    remembered for the next join on it."""
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        base, lookup = _skewed(spark, n=60000)
        subset = base.filter(F.col("v") % 5 != 0)
        split = skew_join(subset, lookup, "paper_id", "left", detect_on=base)
        plain = subset.join(lookup, "paper_id", "left")
        assert "__salt" in plan_text(split)
        assert split.exceptAll(plain).count() == 0 and plain.exceptAll(split).count() == 0
        assert _jobs(spark, "base-again", lambda: hot_profile(base)) == 0
        # the column may have another name there
        renamed = subset.withColumnRenamed("paper_id", "id")
        again = skew_join(renamed, lookup.withColumnRenamed("paper_id", "id"), "id", detect_on=base, detect_key="paper_id")
        assert "__salt" in plan_text(again) and again.count() == plain.count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_mean_weights_alone_read_their_entity_only(spark):
    """W8 by itself: the blank filter is below the join, and no generator runs."""
    text = QUERIES["author_weights_mean"](spark, SF001)._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in text and "affiliation" not in text
    links = text[text.index("l_linenumber") :]
    assert "Filter" in links and "= 7" in text


def test_gap_workflow_reads_the_edges_once_for_all_outputs(spark):
    """X10 with kept intermediates: the edge and link scans of the final plan are at
    most half of the eleven that the unkept plan had."""
    text = QUERIES["all_weights"](spark, SF001)._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"Relation \[l_orderkey", text)) <= 5
    assert "RDD" in text  # checkpointed counts and weights


def test_model_queries_evaluate_the_features_once(spark):
    from scholarmetrics.plans import catalog

    frame = catalog._kept_model_frame(spark, SF001)
    assert "Relation" not in frame._jdf.queryExecution().optimizedPlan().toString()


def test_kept_weights_are_small_files_and_no_link_is_shuffled_by_entity(spark):
    """X10 looks the links up in weights whose size the planner knows: it broadcasts them
    by itself and shuffles by paper alone."""
    old = spark.conf.get("spark.sql.adaptive.enabled", None)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = QUERIES["all_weights"](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old) if old is not None else spark.conf.unset("spark.sql.adaptive.enabled")
    shuffled = re.findall(r"Exchange hashpartitioning\((\w+)#", plan)
    assert plan.count("BroadcastHashJoin") >= 4
    assert "paper_id" in shuffled and not {"author_id", "affiliation_id", "fos_id", "venue"} & set(shuffled)
