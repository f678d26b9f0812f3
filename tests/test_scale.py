"""Plans and results that must hold when tables grow."""

from pyspark.sql import functions as F


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_context_is_null_where_the_genome_is_not_whole(spark):
    """Chunks with a hole and a short end, reach over several chunks, and sites that are rows of their own; no column holds a contig."""
    from methspark.operators.positions import ref_context_at_site

    seq = "ACGTTCGACGCATTCGGCGATTACAGGT" * 12
    starts = [k for k in range(0, len(seq), 64) if k != 128]
    chunks = spark.createDataFrame([("chr1", k, seq[k : k + 64]) for k in starts], "Chr string, chunk_start long, seq string").repartition(3)
    there = {k + i for k in starts for i in range(len(seq[k : k + 64]))}
    sites = spark.range(1, len(seq) + 1).select(F.lit("chr1").alias("Chr"), F.col("id").alias("Pos"))
    for n in (2, 5, 70):
        want = {(p + 1): seq[p - n : p + n + 1] if all(q in there for q in range(p - n, p + n + 1)) else None for p in there}
        got = ref_context_at_site(sites, chunks, n)
        assert {r.Pos: r.context for r in got.collect()} == want
        assert "collect_list" not in plan(got)


def test_genome_sites_are_read_off_their_chunks(spark):
    """No array spans a contig: positions come from each chunk."""
    from methspark.plans.more import genome_sites

    sites, chunks = genome_sites(spark, "/root/testdata/sf0.001")
    assert "Aggregate" not in plan(sites) and sites.count() == chunks.count() * 64


def test_lines_are_split_once(spark):
    """Whatever a scan filters, its plan splits a line once."""
    from methspark.registry import QUERIES

    for name in ("scan_nanopolish", "scan_megalodon", "scan_tombo", "scan_gcf52ref", "scan_uniread", "scan_uniread_abs_cutoff", "scan_rf_consensus_reads", "scan_custom_tool"):
        assert plan(QUERIES[name](spark, "/root/testdata/sf0.001")).split("== Initial Plan ==")[0].count("split(") == 1, name


def test_calls_are_streamed_not_sorted(spark):
    """Joins of calls with sites, truth and alignments hold the smaller side by partition; best and lowest calls are hashed."""
    from methspark.registry import QUERIES

    for name in ("filter_min_read_cov", "semi_join_truth", "unphased_calls"):
        text = plan(QUERIES[name](spark, "/root/testdata/sf0.001"))
        assert "SortMergeJoin" not in text and "SortAggregate" not in text and "ShuffledHashJoin" in text, name
    assert "SortAggregate" not in plan(QUERIES["downsample_reads"](spark, "/root/testdata/sf0.001"))


def test_lowest_and_best_calls_of_odd_scores(spark):
    """A missing score is the lowest; of equal sizes the larger score is the best; NaN is the largest."""
    from methspark.operators.joins import best_call_per_position, dedup_read_calls

    nan = float("nan")
    scores = {"a": [1.0, None], "b": [-2.0, 2.0], "c": [-3.0, 2.0], "d": [nan, 5.0], "e": [None], "f": [-1.0, None]}
    df = spark.createDataFrame([("t", i, "chr1", 1, "+", s) for i, x in scores.items() for s in x], "tool string, ID string, Chr string, Pos long, Strand string, Score double")
    got = lambda out: {r.ID: str(r.Score) for r in out.collect()}
    assert got(dedup_read_calls(df)) == {"a": "None", "b": "-2.0", "c": "-3.0", "d": "5.0", "e": "None", "f": "None"}
    assert got(best_call_per_position(df)) == {"a": "1.0", "b": "2.0", "c": "-3.0", "d": "nan", "e": "None", "f": "-1.0"}


def test_distinct_sorted_rows_are_dealt_once(spark):
    from methspark.operators.joins import sort_distinct_natural

    df = spark.createDataFrame([(c, p, "+", k % 2) for c in ("chr10", "chr2", "chrX") for p in (5, 3) for k in range(4)], "Chr string, Pos long, Strand string, v int").repartition(5)
    out = sort_distinct_natural(df)
    assert [(r.Chr, r.Pos, r.v) for r in out.collect()] == [(c, p, v) for c in ("chr2", "chr10", "chrX") for p in (3, 5) for v in (0, 1)]
    assert "rangepartitioning" in plan(out) and "hashpartitioning" not in plan(out)


def test_kmer_bits_are_the_columns(spark):
    """One vector in the order of the one-hot columns; scores of a model are added without a join."""
    from methspark.models.consensus import features
    from methspark.operators.genome import kmer_onehot

    df = spark.createDataFrame([("ACGTN" * 3 + "AC", 1.0), ("T" * 17, None), (None, 2.0)], "k_mer string, t double")
    wide, names = kmer_onehot(df)
    rows, cols = features(df, ["t"], kmer=True)
    assert cols == ["t", "t_missing", "kmer_bits"]
    assert [list(r[0]) for r in rows.select("kmer_bits").collect()] == [[float(x) for x in r] for r in wide.select(*names).collect()]


def test_stream_state_is_asked_by_groups_of_reads(spark, tmp_path):
    """Reads dealt into two groups keep their own places: one call of the state's function for each group, one row of state for each read."""
    from methspark.streaming import stream as T

    src, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    batches = [
        [("a", "r1", "chr1", 5, "+", 1.0), ("a", "r1", "chr1", 5, "+", 0.5), ("b", "r1", "chr1", 5, "+", 3.0), ("a", "r2", "chr1", 5, "+", None)],
        [("a", "r1", "chr1", 5, "+", -9.0), ("a", "r1", "chr1", 5, "-", 2.0), ("a", "r2", "chr1", 5, "+", 4.0), ("a", "r3", "chr2", 5, "+", 7.0)],
    ]
    for rows in batches:
        spark.createDataFrame(rows, T.CALLS).coalesce(1).write.mode("append").parquet(src)
        query = T.stream_unify_batches(spark, src, out, state, groups=2)
        query.awaitTermination()
        last = [p for p in query.recentProgress if p.numInputRows > 0][-1].stateOperators[0]
    assert "transformWithState" in last.operatorName and last.numRowsTotal == 4
    got = sorted((r.tool, r.ID, r.Strand, str(r.Score)) for r in spark.read.parquet(out).collect())
    assert got == [("a", "r1", "+", "0.5"), ("a", "r1", "-", "2.0"), ("a", "r2", "+", "None"), ("a", "r3", "+", "7.0"), ("b", "r1", "+", "3.0")]


def test_class_balance_counts_before_facets(spark):
    """A row becomes one for each facet after rows were counted; values that are equal as text, and missing ones, are one."""
    from methspark.operators.sites import class_balance

    rows = [("chr1", 1, "+", "a", 1), ("chr1", 1, "+", "a", 1), ("chr1", 1, "+", "b", None), ("chr2", 1, "+", "b", 0), ("chr2", 1, "+", None, 0)]
    out = class_balance(spark.createDataFrame(rows, "Chr string, Pos long, Strand string, tool string, label int"), ["label", "tool"])
    got = {(r.facet, r.value): (r.n, r.sites, r.share, r.site_share) for r in out.collect()}
    assert got == {
        ("label", "1"): (2, 1, 0.4, 0.5), ("label", "0"): (2, 1, 0.4, 0.5), ("label", None): (1, 1, 0.2, 0.5),
        ("tool", "a"): (2, 1, 0.4, 0.5), ("tool", "b"): (2, 2, 0.4, 1.0), ("tool", None): (1, 1, 0.2, 0.5), ("total", "all"): (5, 2, 1.0, 1.0),
    }
    text = plan(out).split("== Initial Plan ==")[0]
    assert "HashAggregate" in text[text.index("Generate") :]


def call_scans(df) -> int:
    """How many scans of the calls' table a plan has; a view of all callers has three."""
    return sum("Scan parquet" in line and "l_quantity" in line for line in plan(df).split("== Initial Plan ==")[0].splitlines())


def test_reads_become_sites_before_joins(spark):
    """Calls are read once, and no join with truth or regions carries a read."""
    from methspark.registry import QUERIES

    out = QUERIES["agg_read_to_site_multitool"](spark, "/root/testdata/sf0.001")
    assert call_scans(out) == 3


def test_calls_off_the_sites_go_before_reads_are_put_together(spark):
    """The same rows as a join after the pivot, by one shuffle of the calls."""
    from methspark.operators.joins import join_tools, join_tools_on_sites, join_truth

    rows = [(t, f"r{k % 5}", f"chr{1 + k % 2}", k % 7, "+-"[k % 2], None if k % 11 == 0 else float(k)) for k in range(120) for t in ("a", "b", "c") if (k + len(t) * ord(t)) % 3]
    calls = spark.createDataFrame(rows, "tool string, ID string, Chr string, Pos long, Strand string, Score double")
    sites = spark.createDataFrame([(f"chr{1 + p % 2}", p, s, p % 2) for p in range(0, 7, 2) for s in "+-"], "Chr string, Pos long, Strand string, label int")
    out, cols = join_tools_on_sites(calls, ["a", "b"], sites), ["ID", "Chr", "Pos", "Strand", "a", "b", "label"]
    got = lambda df: sorted(map(str, df.select(*cols).collect()))
    assert got(out) == got(join_truth(join_tools(calls, ["a", "b"], "outer"), sites)) != []
    text = plan(out).split("== Initial Plan ==")[0]
    assert "SortMergeJoin" not in text and text.count("Exchange hashpartitioning") == 2


def test_forest_reads_its_training_rows_once(spark):
    from methspark.models.consensus import predict_rf_scaled

    read = spark.sparkContext.accumulator(0)
    rows = [(f"r{k}", "chr1", k, "+", float(k % 9), float(k % 4), k % 2) for k in range(200)]
    schema = "ID string, Chr string, Pos long, Strand string, a double, b double, label int"
    train = spark.createDataFrame(spark.sparkContext.parallelize(rows, 2).map(lambda r: (read.add(1), r)[1]), schema)
    assert predict_rf_scaled(train, spark.createDataFrame(rows, schema), ["a", "b"]).count() == 200
    assert read.value == 200


def test_sorted_distinct_text_is_dealt_once(spark, tmp_path, monkeypatch):
    """Equal rows are told apart inside the sorted ranges; the text is in natural order, missing values and equal zeros included."""
    from methspark.operators import exports as X

    rows = [(i, c, p, "+", s) for c in ("chr10", "chr2", "chrX") for p in (5, 3) for i in ("r1", None) for s in (0.5, -1.0, None)]
    schema = "ID string, Chr string, Pos bigint, Strand string, Score double"
    path, shuffles = str(tmp_path / "out"), []
    df = spark.createDataFrame(rows * 3, schema).repartition(5)
    native = type(df).repartitionByRange
    monkeypatch.setattr(type(df), "repartitionByRange", lambda self, *c: shuffles.append(native(self, *c)) or shuffles[-1])
    X.write_text(df, path, sort=True, distinct=True)
    got = X.read_sorted(spark, path, schema).collect()
    order = {"chr2": 0, "chr10": 1, "chrX": 2}
    assert sorted(map(tuple, got), key=str) == sorted(rows, key=str)
    assert [(r.Chr, r.Pos) for r in got] == sorted(((r.Chr, r.Pos) for r in got), key=lambda x: (order[x[0]], x[1]))
    assert len(shuffles) == 1 and "hashpartitioning" not in plan(shuffles[0].distinct())


def test_regions_of_sites_need_no_union_by_site(spark):
    """Sites and their tags are joined once; what groups by site is no union of sides that adaptive execution may coalesce unequally. Sites of no region, repeated sites and null places keep Genome-wide."""
    from methspark.operators.joins import annotate_regions_multi

    sites = spark.createDataFrame([("chr1", 5, "+", 1), ("chr1", 5, "+", 2), ("chr1", 5, "-", 3), ("chr9", 1, "+", 4), (None, 7, "+", 5)], "Chr string, Pos long, Strand string, v int")
    regions = spark.createDataFrame([("a", "chr1", 1, 9, "+"), ("a", "chr1", 2, 6, "+"), ("rep_SINE", "chr1", 1, 9, "+"), (None, "chr1", 5, 5, "-")], "tag string, Chr string, start long, stop long, Strand string")
    out = annotate_regions_multi(sites, regions)
    assert out.columns == ["Chr", "Pos", "Strand", "v", "tag"] and plan(out).count("Union") == 1  # of short and long regions
    every = {(v, "Genome-wide") for v in range(1, 6)}
    rows = [(r.v, r.tag) for r in out.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == every | {(v, "a") for v in (1, 2, 3)} | {(1, "rep_SINE"), (2, "rep_SINE"), (3, None)}


def test_fit_reads_stored_rows(spark):
    """The rows of a fit, and what weights them, hang on stored rows, not on the plan that joins all calls; a fit's jobs would each carry that along."""
    from methspark.plans import more

    rows = more.training_rows(spark, "/root/testdata/sf0.001")
    assert "lineitem" not in rows._jdf.queryExecution().toString() and rows.count() > 0
    assert rows.where("weight is null").count() == 0
