"""Golden lines of the text formats, streaming, and small checks of edge cases."""

from pyspark.sql import functions as F

from methspark.functions import scalar as S
from methspark.operators import joins as J
from methspark.operators import positions as P
from methspark.sources import scans as R
from methspark.streaming import stream as T


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_nanopolish_splits_motifs_and_skips_headers(spark):
    text = ["chromosome\tstrand\tstart\tend\tread_name\tllr\ta\tb\tc\tnum_motifs\tsequence", "chr1\t-\t100\t110\tr1\t-9.0\t0\t0\t1\t2\tAAAAACGTTTCGAAAAA", "chr1\t+\t100\t101\tr2\t1.5\t0\t0\t1\t1\tAAAAACGAAAA"]
    got = [tuple(r) for r in R.scan_nanopolish(lines(spark, *text)).orderBy("Pos").collect()]
    assert got == [("r1", "chr1", 102, "-", -9.0, 0), ("r1", "chr1", 107, "-", -9.0, 0)]


def test_bad_lines_are_dropped(spark):
    got = R.scan_uniread(lines(spark, "ID\tChr\tPos\tStrand\tScore", "r\tchr1\tx\t+\t1", "r\tchr1\t5\t+\t2.5", "short")).collect()
    assert [tuple(r) for r in got] == [("r", "chr1", 5, "+", 2.5, 1)]


def test_duplicate_site_fails(spark):
    import pytest

    with pytest.raises(Exception, match="duplicate site"):
        R.unique_sites(R.scan_bs_bismark(lines(spark, "chr1\t5\t+\t1\t1\tx\ty", "chr1\t5\t+\t1\t1\tx\ty"))).collect()


def test_long_regions_and_both_ends(spark):
    points = spark.createDataFrame([("chr1", p, "+") for p in (9, 10, 500_000, 900_000, 900_001)], "Chr string, Pos bigint, Strand string")
    regions = spark.createDataFrame([("a", "chr1", 10, 900_000, "+"), ("b", "chr1", 10, 10, "-")], "tag string, Chr string, start bigint, stop bigint, Strand string")
    assert sorted((r.Pos, r.tag) for r in J.interval_pairs(points, regions).collect()) == [(10, "a"), (10, "b"), (500_000, "a"), (900_000, "a")]


def test_islands_do_not_depend_on_tiles(spark):
    cpg = spark.range(0, 300).select(F.lit("chr1").alias("Chr"), (F.col("id") * 7 + F.pmod(F.xxhash64("id"), F.lit(9))).alias("pos_c"))
    one, two = (sorted(map(tuple, P.singleton_islands(cpg, tile=t).collect())) for t in (50, 1_000_000))
    assert one == two


def test_duration_and_size(spark):
    df = spark.createDataFrame([("1h 52m 55s", "512 MB"), ("311ms", "1.5 GB"), ("x", "0")], "d string, s string")
    got = [tuple(r) for r in df.select(S.duration_seconds(F.col("d")), S.size_gb(F.col("s"))).collect()]
    assert got == [(6775.0, 0.5), (0.311, 1.5), (None, 0.0)]


def test_streams(spark, tmp_path):
    rows = [("a", "r1", "chr1", 5, "+", 1.0), ("a", "r1", "chr1", 5, "+", 0.5), ("a", "r2", "chr1", 5, "+", -1.0)]
    src, out, counts = (str(tmp_path / n) for n in ("in", "out", "counts"))
    for k in range(2):
        spark.createDataFrame(rows, T.CALLS).write.mode("append").parquet(src)
        T.stream_unify_batches(spark, src, out, str(tmp_path / "c1")).awaitTermination()
        T.stream_site_counts(spark, src, counts, str(tmp_path / "c2")).awaitTermination()
    assert sorted((r.ID, r.Score) for r in spark.read.parquet(out).collect()) == [("r1", 0.5), ("r2", -1.0)]
    assert [(r.cov, r.meth) for r in T.site_counts(spark, counts).collect()] == [(6, 4)]


def fasta(rng, contigs):
    """Text of contigs in lines of many widths, and its chunks."""
    text, want = ["; no header yet ACGT"], []
    for name, size in contigs:
        seq = "".join(rng.choices("ACGTN", k=size))
        text.append(f">{name} length={size}")
        at = 0
        while at < size:
            step = rng.choice([1, 7, 60, 61, 64, 200])
            text.append(seq[at : at + step].lower() + rng.choice(["", " ", "\r"]))
            at += step
            if rng.random() < 0.1:
                text.append("")
        want += [(name, k, seq[k : k + 64]) for k in range(0, size, 64)]
    return text, sorted(want)


def test_fasta_contigs_go_on_over_splits_and_files(spark, tmp_path):
    """The same chunks from one split, from splits of some hundred bytes, and from a text cut into files anywhere."""
    import random

    from methspark.sources.tables import scan_fasta_chunks

    text, want = fasta(random.Random(4), [("chr1", 5000), ("empty", 0), ("chr2", 63), ("chr3", 64), ("chr10", 12345)])
    one = tmp_path / "one"
    one.mkdir()
    (one / "genome.fa").write_text("\n".join(text) + "\n")
    parts = tmp_path / "parts"
    parts.mkdir()
    for k in range(0, len(text), 37):
        (parts / f"part-{k // 37}.txt").write_text("\n".join(text[k : k + 37]) + "\n")
    conf = {"spark.sql.files.maxPartitionBytes": "512", "spark.sql.files.openCostInBytes": "64"}
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(scan_fasta_chunks(spark, str(one))) == want
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        assert spark.read.text(str(one)).rdd.getNumPartitions() > 10
        assert rows(scan_fasta_chunks(spark, str(one))) == want
        assert rows(scan_fasta_chunks(spark, str(parts), continued=True)) == want
        apart = scan_fasta_chunks(spark, str(parts)).collect()  # files on their own begin with lines of no header
        assert sum(len(r.seq) for r in apart) < sum(len(s) for _, _, s in want)
    finally:
        for k in conf:
            spark.conf.unset(k)


def arriving(spark, k: int):
    """Call file k: 40 reads, some of which an earlier file held in part."""
    r, s = F.col("id") % 40 + 25 * k, F.floor(F.col("id") / 40)
    return spark.range(320).select(F.lit("a").alias("tool"), F.concat(F.lit("r"), r).alias("ID"), F.lit("chr1").alias("Chr"), (10 * s + r % 3).alias("Pos"), F.lit("+").alias("Strand"), ((F.col("id") * 7 + k) % 11 - 5.0).alias("Score"))


def progress(query) -> list:
    """The batches of a finished query that had rows."""
    query.awaitTermination()
    assert query.exception() is None
    return [p for p in query.recentProgress if p.numInputRows > 0]


def test_unified_stream_reads_new_rows_only(spark, tmp_path):
    """Ten batches: each reads its own rows alone, touches its own reads' state alone, and none of the output; a batch run again adds nothing."""
    src, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    seen, batches = {}, []
    for k in range(10):
        arriving(spark, k).coalesce(1).write.mode("append").parquet(src)
        batches += progress(T.stream_unify_batches(spark, src, out, state))
        for r in sorted(arriving(spark, k).collect(), key=lambda r: r.Score):
            seen.setdefault((r.ID, r.Pos), (k, r.Score))
    assert [p.numInputRows for p in batches] == [320] * 10
    assert all(p.stateOperators[0].numRowsUpdated <= 40 for p in batches) and batches[-1].stateOperators[0].numRowsTotal == 40 + 9 * 25
    rows = lambda: sorted((r.ID, r.Pos, r.Score) for r in spark.read.parquet(out).collect())
    want = sorted((i, p, s) for (i, p), (_, s) in seen.items())
    assert rows() == want
    for mark in (tmp_path / "state" / "commits").glob("*9*"):  # the last batch counts as not finished
        mark.unlink()
    T.stream_unify_batches(spark, src, out, state).awaitTermination()
    assert rows() == want


def test_site_store_has_one_row_for_each_site(spark, tmp_path):
    """After any number of batches, merged or not; changes of merged batches go; a batch put again changes nothing."""
    src, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    want: dict = {}
    for k in range(7):
        arriving(spark, k).coalesce(1).write.mode("append").parquet(src)
        assert len(progress(T.stream_site_counts(spark, src, out, state, every=3))) == 1
        for r in arriving(spark, k).collect():
            c = want.setdefault(r.Pos, [0, 0])
            c[0], c[1] = c[0] + 1, c[1] + (r.Score > 1e-5)
        got = T.site_counts(spark, out).collect()
        assert {r.Pos: [r.cov, r.meth] for r in got} == want and len(got) == len(want)
    store = T.SiteStore(spark, out)
    assert [n for n, _ in store.parts()] == [5, 6] and store._numbers("merged") == [2, 5] and store._numbers("changes") == [3, 4, 5, 6]
    assert spark.read.parquet(store.parts()[0][1]).count() == len(want)
    for mark in (tmp_path / "state" / "commits").glob("*6*"):
        mark.unlink()
    T.stream_site_counts(spark, src, out, state, every=3).awaitTermination()
    assert {r.Pos: [r.cov, r.meth] for r in T.site_counts(spark, out).collect()} == want
    assert T.site_counts(spark, str(tmp_path / "none")).count() == 0


def test_classes_are_those_of_islands(spark):
    """Random CpGs and certain sites: singletons by chained gaps, concordance by all labels of the island in reach; tiles do not matter."""
    import random

    from methspark.operators import classes as K

    rng = random.Random(9)
    cpg, at = [], 100
    for _ in range(400):
        at += rng.choice([2, 3, 9, 11, 12, 13, 30])
        cpg.append(at)
    certain = [(c + (s == "-"), s, float(rng.random() < 0.5 if rng.random() < 0.3 else c % 200 < 100)) for c in cpg for s in "+-" if rng.random() < 0.6] + [(5000, "+", 1.0)]
    island, runs = {}, [[cpg[0]]]
    for a, b in zip(cpg, cpg[1:], strict=False):
        runs.append([b]) if b - (a + 2) >= 10 else runs[-1].append(b)
    for r in runs:
        island |= {c: r for c in r}
    label: dict = {}
    for p, s, f in certain:
        label.setdefault(p - (s == "-"), set()).add(f)
    want = {}
    for c in cpg:
        near = set().union(*[label.get(o, set()) for o in island[c] if abs(o - c) - 2 < 10])
        want[c] = 1 if len(island[c]) == 1 else 2 | (0 if c not in label else 4 if len(near) == 1 else 8)
    sites = spark.createDataFrame([("chr1", *x) for x in certain], "Chr string, Pos long, Strand string, freq double")
    genome = spark.createDataFrame([("chr1", c) for c in cpg] + [("chr1", cpg[0])], "Chr string, pos_c long")
    for tile in (40, 1000, 10**6):
        got = K.cpg_classes(genome, sites, tile=tile).collect()
        assert {r.pos_c: r.mask for r in got} == want and len(got) == len(want)


def test_sorted_text_is_one_sorted_file(spark, tmp_path):
    """The files one after the other are in natural order; a text that is not is refused."""
    import gzip

    import pytest

    from methspark.operators import exports as X

    names = ["chr10", "chr2", "chr1", "chrX", "chrM", "chr22"]
    rows = [(n, (7919 * k) % 5003, "+-"[k % 2], k % 11 / 10, k) for n in names for k in range(500)]
    df = spark.createDataFrame(rows, "Chr string, Pos long, Strand string, freq double, cov long").repartition(7)
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        X.write_text(df, str(tmp_path / "a"), sort=True)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    files = sorted((tmp_path / "a").glob("part-*.gz"))
    text = [tuple(x.split("\t")) for f in files for x in gzip.open(f, "rt").read().split("\n") if x]
    order = {n: k for k, n in enumerate(["chr1", "chr2", "chr10", "chr22", "chrX", "chrM"])}
    assert len(files) > 3 and len(text) == len(rows)
    assert [t[:3] for t in text] == [(r[0], str(r[1]), r[2]) for r in sorted(rows, key=lambda r: (order[r[0]], r[1], r[2]))]
    schema = "Chr string, Pos long, Strand string, freq double, cov long"
    assert sorted(map(tuple, X.read_sorted(spark, str(tmp_path / "a"), schema).collect())) == sorted(rows)
    X.write_text(df, str(tmp_path / "b"))
    with pytest.raises(ValueError, match="out of order"):
        X.read_sorted(spark, str(tmp_path / "b"), schema)
    keys = X.export_keyset(df)
    X.write_text(keys, str(tmp_path / "c"), sort=True)
    got = [r.key for r in X.read_sorted(spark, str(tmp_path / "c"), "key string").collect()]
    assert len(got) == len({(r[0], r[1], r[2]) for r in rows}) and [int(k.split("_")[1]) for k in got if k.startswith("chr2_")] == sorted(r[1] for r in rows if r[0] == "chr2")


def test_tails_and_densities(spark):
    """Normal and Student tails against erfc and known quantiles; a grid's densities against a plain sum over all points."""
    import math

    import numpy as np

    from methspark.functions import distributions as D
    from methspark.operators.reports import density_grid

    zs = [0.0, 0.1, 1.0, 1.96, -2.5, 3.5, 3.6, 5.0, 10.0, 30.0]
    got = [r[0] for r in spark.createDataFrame([(z,) for z in zs], "z double").select(D.normal_two_sided(F.col("z"))).collect()]
    assert all(math.isclose(g, math.erfc(abs(z) / math.sqrt(2)), rel_tol=1e-9) for g, z in zip(got, zs, strict=True))
    # fixed values: two-sided 5 % and 1 % points of Student's t for 1, 5, 10, 30 and 120 degrees of freedom
    points = {1: (12.7062047364, 63.6567411629), 5: (2.57058183661, 4.03214298356), 10: (2.22813885196, 3.16927267262), 30: (2.04227245630, 2.74999565357), 120: (1.97993040508, 2.61742114477)}
    steps = np.linspace(0, 1, 200_001)

    def beyond(t, df):  # Simpson's rule over the density's angle
        at = math.atan(t / math.sqrt(df))
        y = np.cos(at + steps * (math.pi / 2 - at)) ** (df - 1)
        scale = 2 * math.exp(math.lgamma((df + 1) / 2) - math.lgamma(df / 2)) / math.sqrt(math.pi)
        return float(scale) * (math.pi / 2 - at) * float(y[0] + y[-1] + 4 * y[1:-1:2].sum() + 2 * y[2:-1:2].sum()) / 600_000

    many = [(t * t, float(df), beyond(t, df)) for df in (15_000, 20_000, 20_001, 10**6) for t in (0.3, 1.5, 3.0, 5.0)]
    rows = many + [(t * t, float(df), p) for df, ts in points.items() for t, p in zip(ts, (0.05, 0.01), strict=True)] + [(0.0, 7.0, 1.0), (1e9, 40.0, 0.0)]
    out = spark.createDataFrame(rows, "t2 double, df double, p double").select(D.student_two_sided(F.col("t2"), F.col("df")), "p").collect()
    assert all(abs(a - b) < 1e-9 for a, b in out)
    rng = np.random.default_rng(2)
    a, b, bins = rng.beta(0.5, 0.5, 300), rng.beta(2, 3, 300), 30
    df = spark.createDataFrame([("t", float(x), float(y)) for x, y in zip(a, b, strict=True)] + [("one", 0.5, 0.5), ("t", None, 0.5)], "tool string, a double, b double")
    grid = {(r.kind, r.x, r.y): r.density for r in density_grid(df, "a", "b", bins=bins).where("tool = 't'").collect()}
    cell = lambda v: np.minimum(np.floor(v * bins + 1e-9), bins - 1).astype(int)
    counts = np.zeros((bins, bins))
    np.add.at(counts, (cell(a), cell(b)), 1 / 300)

    def kernel(v, d):
        h, at = v.std(ddof=1) * 300 ** (-1 / (d + 4)), np.arange(-bins + 1, bins)
        return np.where(abs(at) <= math.ceil(4 * h * bins), np.exp(-((at / bins / h) ** 2) / 2) / (h * math.sqrt(2 * math.pi)), 0)

    smooth = lambda v, k: np.convolve(v, k)[bins - 1 : 2 * bins - 1]
    both = np.apply_along_axis(smooth, 1, np.apply_along_axis(smooth, 0, counts, kernel(a, 2)), kernel(b, 2))
    ones = {"x": smooth(counts.sum(1), kernel(a, 1)), "y": smooth(counts.sum(0), kernel(b, 1))}
    for x in range(bins):
        assert abs(grid.get(("x", x, None), 0) - ones["x"][x]) < 1e-9 and abs(grid.get(("y", None, x), 0) - ones["y"][x]) < 1e-9
        assert all(abs(grid.get(("xy", x, y), 0) - both[x, y]) < 1e-9 for y in range(bins))


def test_mock_bisulfite_reads(spark):
    """Spans over several chunks, both strands, calls outside the span, a read beyond the genome."""
    import re

    from methspark.operators import genome as G

    seq = "ACGTTCGACGCATTCGGCGA" * 20
    chunks = spark.createDataFrame([("chr1", k, seq[k : k + 64]) for k in range(0, len(seq), 64)], "Chr string, chunk_start long, seq string").repartition(3)
    reads = [("a", "+", 60, 130), ("b", "-", 3, 67), ("c", "+", 350, 401), ("d", "-", 64, 128), ("e", "+", 0, 10)]
    at = [m.start() for m in re.finditer("CG", seq)]
    calls = [(i, s, p + (2 if s == "-" else 1), v) for i, s, _, _ in reads[:4] for k, p in enumerate(at) for v in [(-3.0, 3.0, 0.5)[k % 3]]]
    got = G.mock_bisulfite_reads(spark.createDataFrame([(i, "chr1", s, a, b) for i, s, a, b in reads], "ID string, Chr string, Strand string, start0 long, end0 long"), spark.createDataFrame([("t", i, "chr1", p, s, v) for i, s, p, v in calls], "tool string, ID string, Chr string, Pos long, Strand string, Score double"), chunks).collect()
    want = {}
    for i, s, a, b in (reads[0], reads[1], reads[3]):
        text, shift = list(seq[a:b]), 1 if s == "-" else 0
        sites = [m.start() for m in re.finditer("CG", seq[a:b])]
        for c in sites:
            if (at.index(c + a)) % 3 != 1 and c + shift < len(text):
                text[c + shift] = "N"
        for k, p in enumerate(at):
            if k % 3 == 0 and a <= p < b and p - a + shift < len(text):
                text[p - a + shift] = "A" if s == "-" else "T"
        want[i] = "".join(text)
    assert {r.ID: r.seq for r in got} == want
