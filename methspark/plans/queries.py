"""One query for each operator over the derived views, with the same result in SQL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import scalar as S
from ..operators import classes as K
from ..operators import exports as X
from ..operators import haplotype as H
from ..operators import joins as J
from ..operators import metrics as M
from ..operators import positions as P
from ..operators import sites as A
from ..sources import scans as R
from ..storage import folder
from .fixtures import ctes, view

QUERIES: dict = {}
ORACLE: dict[str, str] = {}
TOOLS = ["nanopolish", "megalodon", "deepsignal"]
SITE = J.SITE
SITES = "Chr, Pos, Strand"


def query(sql: str = "", *views: str):
    """Registers a function by its name, and its SQL after the views' definitions."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = f"{ctes(*views)} {sql}" if views else sql
        return f

    return add


def r6(*cols: str):
    return {c: F.round(F.col(c), 6) for c in cols}


def calls(spark, sf):
    return view(spark, sf, "read_call")


def labelled(spark, sf):
    return A.labelled(calls(spark, sf))


def site_calls(spark, sf):
    return A.agg_read_to_site(labelled(spark, sf))


def truth(spark, sf, rep=None):
    t = view(spark, sf, "bs_truth")
    return t.where(F.col("rep") == rep) if rep else t


def union_truth(spark, sf, min_cov=1):
    return J.truth_union_replicates(truth(spark, sf), min_cov)


def certain_sites(spark, sf, rep=None):
    """Sites of certain truth, of both replicates together or of one."""
    t = truth(spark, sf, rep)
    return A.filter_certain_sites(J.truth_union_replicates(t, 5))


def known_calls(spark, sf, rep=None):
    """Calls on certain sites with truth: tool, SITE, y_true, y_pred, y_score; and the sites with their regions."""
    certain = certain_sites(spark, sf, rep).select(*SITE, S.freq_to_label(F.col("freq")).alias("y_true"))
    rows = J.join_truth(labelled(spark, sf), certain).select("tool", *SITE, "y_true", F.col("label").alias("y_pred"), F.col("Score").alias("y_score"))
    return rows, J.annotate_regions_multi(certain.select(*SITE), view(spark, sf, "region_view").where("tag is not null"))


def tagged(spark, sf):
    """Calls on certain sites with truth, by region."""
    rows, tags = known_calls(spark, sf)
    return rows.join(tags, SITE).select("tool", "tag", "y_true", "y_pred", "y_score")


def site_counts(spark, sf, rep=None):
    """The same as call counts by site."""
    rows, tags = known_calls(spark, sf, rep)
    return M.call_counts(rows).join(tags, SITE)


def scored(spark, sf):
    """The same as numbers of equal scores, counted by site before regions are told apart."""
    rows, tags = known_calls(spark, sf)
    counts = rows.groupBy("tool", *SITE, "y_true", "y_score").agg(F.count("*").alias("n")).join(tags, SITE)
    return counts.groupBy("tool", "tag", "y_true", "y_score").agg(F.sum("n").alias("n"))


LABEL = "case when Score > 0.00001 then 1 else 0 end"
SITE_CALLS = f"site_calls as (select tool, {SITES}, avg(cast({LABEL} as double)) as freq, count(*) as cov, sum({LABEL}) as meth from read_call group by tool, {SITES})"
UNION = f"union_truth as (select {SITES}, cast(meth as double) / cov as freq, cov, meth from (select {SITES}, sum(meth) as meth, sum(cov) as cov from bs_truth group by {SITES}))"
CERTAIN = f"certain as (select {SITES}, case when freq < 0.5 then 0 else 1 end as y_true, freq, cov from union_truth where cov >= 5 and (freq < 0.00001 or freq > 0.99999))"
TAGS = f"tags as (select distinct {SITES}, tag from certain c join (select tag, Chr as rc, start, stop, Strand as rs from region_view) on Chr = rc and Pos between start and stop and (tag <> 'rep_SINE' or Strand = rs) union all select {SITES}, 'Genome-wide' from certain)"
ROWS = f"rws as (select tool, tag, y_true, {LABEL} as y_pred, Score as y_score, {SITES} from read_call join certain using ({SITES}) join tags using ({SITES}))"
EVAL = f", {UNION}, {CERTAIN}, {TAGS}, {ROWS}"


def lines(df, *cols):
    """One text line for each row, as the scans read them."""
    return df.select(F.concat_ws("\t", *map(text, cols)).alias("value"))


def text(c):
    """A column's name, a column, or a function that makes one (columns need a session) as a text column."""
    return F.col(c).cast("string") if isinstance(c, str) else c if isinstance(c, Column) else c()


# --- scans ---------------------------------------------------------------------------------------

def START():
    return (F.col("Pos") - F.when(F.col("Strand") == "-", 2).otherwise(1)).cast("string")


def POS0():
    return (F.col("Pos") - 1).cast("string")


def DASH():
    return F.lit("x")


@query(f"select ID, Chr, Pos + o as Pos, Strand, Score, {LABEL} as label from (select *, unnest(case when Pos % 2 = 1 then [0, 4] else [0] end) as o from read_call where tool = 'nanopolish') where abs(Score) >= 2 * (1 + Pos % 2)", "read_call")
def scan_nanopolish(spark, sf):
    """Calls of one motif and of two, four bases apart."""
    df, two = calls(spark, sf).where("tool = 'nanopolish'"), F.col("Pos") % 2 == 1
    return R.scan_nanopolish(lines(df, "Chr", "Strand", START, DASH, "ID", "Score", DASH, DASH, DASH, F.when(two, "2").otherwise("1"), F.when(two, "AAAAACGTTCGAAAAA").otherwise("AAAAACGAAAA")))


@query(f"select ID, Chr, Pos, Strand, round(log2((p + 0.00001) / (1 - p + 0.00001)), 6) as Score, {LABEL} as label from (select *, 0.5 + Score / 16 as p from read_call where tool = 'deepsignal')", "read_call")
def scan_deepsignal(spark, sf):
    df = calls(spark, sf).where("tool = 'deepsignal'").withColumn("p", 0.5 + F.col("Score") / 16)
    out = R.scan_deepsignal(lines(df, "Chr", POS0, "Strand", DASH, "ID", DASH, (1 - F.col("p")).cast("string"), "p", S.score_to_label(F.col("Score")).cast("string"), DASH))
    return out.withColumns(r6("Score"))


@query("select ID, Chr, Pos, Strand, -Score as Score, case when Score < -1.5 then 1 else 0 end as label from read_call where tool = 'deepsignal' and (Score < -1.5 or Score > 2.5)", "read_call")
def scan_tombo(spark, sf):
    df = calls(spark, sf).where("tool = 'deepsignal'")
    return R.scan_tombo(lines(df, "Chr", START, START, "ID", "Score", "Strand", DASH))


MEGA = "select ID, Chr, Pos, Strand, abs(Score) as a, Score from read_call where tool = 'megalodon'"


@query(f"select ID, Chr, Pos, Strand, round(Score, 6) as Score, case when Score > 0 then 1 else 0 end as label from ({MEGA}) where 1 / (1 + exp(-a)) >= 0.8", "read_call")
def scan_megalodon(spark, sf):
    df = calls(spark, sf).where("tool = 'megalodon'").withColumns({"m": -F.ln(1 + F.exp(-F.col("Score"))), "c": -F.ln(1 + F.exp("Score"))})
    return R.scan_megalodon(lines(df, "ID", "Chr", "Strand", POS0, "m", "c", F.lit("m"))).withColumns(r6("Score"))


@query(f"select ID, Chr, Pos, Strand, Score, {LABEL} as label from read_call where tool = 'nanopolish'", "read_call")
def scan_uniread(spark, sf):
    return R.scan_uniread(lines(calls(spark, sf).where("tool = 'nanopolish'"), "ID", "Chr", "Pos", "Strand", "Score"))


@query(f"select ID, Chr, Pos, Strand, Score, {LABEL} as label from read_call where tool = 'megalodon' and abs(Score) >= 1.5", "read_call")
def scan_uniread_abs_cutoff(spark, sf):
    return R.scan_uniread_abs_cutoff(lines(calls(spark, sf).where("tool = 'megalodon'"), "ID", "Chr", "Pos", "Strand", "Score"), 1.5)


@query("select ID, Chr, Pos, Strand, round(log2((p + 0.00001) / (1 - p + 0.00001)), 6) as Score, case when Score > 0 then 1 else 0 end as label from (select *, 0.5 + Score / 16 as p from read_call where tool = 'deepsignal')", "read_call")
def scan_consensus_reads(spark, sf):
    df = calls(spark, sf).where("tool = 'deepsignal'").withColumn("p", 0.5 + F.col("Score") / 16)
    return R.scan_consensus_reads(lines(df, "ID", "Chr", "Pos", "Strand", S.score_to_label(F.col("Score")).cast("string"), "p")).withColumns(r6("Score"))


@query("select ID, Chr, Pos, Strand, round(log2((p + 0.00001) / (1 - p + 0.00001)), 6) as Score, case when Score > 0 then 1 else 0 end as label from (select *, 0.5 + Score / 16 as p from read_call where tool = 'deepsignal')", "read_call")
def scan_rf_consensus_reads(spark, sf):
    df = calls(spark, sf).where("tool = 'deepsignal'").withColumn("p", 0.5 + F.col("Score") / 16)
    return R.scan_consensus_reads(lines(df, "ID", "Chr", "Pos", S.score_to_label(F.col("Score")).cast("string"), "p", "Strand"), forest=True).withColumns(r6("Score"))


@query(f"select ID, Chr, Pos, Strand, round(log2((p + 0.00001) / (1 - p + 0.00001)), 6) as Score, case when p <= 0.25 then 0 else 1 end as label from (select *, 0.515625 + Score / 16 as p from read_call where tool = 'megalodon') where p <= 0.25 or p >= 0.5", "read_call")
def scan_gcf52ref(spark, sf):
    df = calls(spark, sf).where("tool = 'megalodon'").withColumn("p", 0.515625 + F.col("Score") / 16)
    return R.scan_gcf52ref(lines(df, "Chr", "Strand", START, DASH, "ID", DASH, F.log10("p").cast("string"))).withColumns(r6("Score"))


TRUTH1 = f"select {SITES}, round(freq, 6) as freq, cov, meth from bs_truth where rep = 1"


@query(f"select {SITES}, round(freq, 6) as freq, cov, meth from bs_truth where rep = 1 and cov >= 3", "bs_truth")
def scan_bs_encode(spark, sf):
    df = truth(spark, sf, 1)
    return R.scan_bs_encode(lines(df, "Chr", POS0, "Pos", DASH, "cov", "Strand", POS0, "Pos", DASH, "cov", (100 * F.col("freq")).cast("string")), min_cov=3).withColumns(r6("freq"))


@query(TRUTH1, "bs_truth")
def scan_bs_bismark(spark, sf):
    df = truth(spark, sf, 1)
    return R.unique_sites(R.scan_bs_bismark(lines(df, "Chr", "Pos", "Strand", "meth", (F.col("cov") - F.col("meth")).cast("string"), DASH, DASH))).withColumns(r6("freq"))


@query(f"select {SITES}, round(freq, 6) as freq, cov + 2 as cov, cast(round_even(freq * (cov + 2), 0) as bigint) as meth from bs_truth where rep = 1", "bs_truth")
def scan_bs_5hmc(spark, sf):
    df = truth(spark, sf, 1)
    return R.scan_bs_5hmc(lines(df, "Chr", "Pos", "Pos", "freq", DASH, DASH, DASH, "Strand", "cov", (F.col("cov") + 2).cast("string"))).withColumns(r6("freq"))


@query(f"select {SITES}, round(freq, 6) as freq, cov, cast(floor(freq * cov) as bigint) as meth from bs_truth where rep = 2", "bs_truth")
def scan_unisite(spark, sf):
    return R.scan_unisite(lines(truth(spark, sf, 2), "Chr", POS0, "Pos", F.lit("."), F.lit("."), "Strand", "freq", "cov")).withColumns(r6("freq"))


@query(TRUTH1, "bs_truth")
def scan_deepmod_c(spark, sf):
    df = truth(spark, sf, 1)
    cols = ["Chr", POS0, "Pos", F.lit("C"), "cov", "Strand", POS0, "Pos", F.lit("0,0,0"), "cov", F.floor(100 * F.col("freq")).cast("string"), "meth"]
    return R.unique_sites(R.scan_deepmod(df.select(F.concat_ws(" ", *map(text, cols)).alias("value")))).withColumns(r6("freq"))


@query(f"select {SITES}, floor(100 * freq) / 100 as freq, cov, meth from bs_truth where rep = 1", "bs_truth")
def scan_deepmod_cluster(spark, sf):
    df = truth(spark, sf, 1)
    pct = F.floor(100 * F.col("freq")).cast("string")
    cols = ["Chr", POS0, "Pos", F.lit("C"), "cov", "Strand", POS0, "Pos", F.lit("0,0,0"), "cov", pct, "meth", pct]
    return R.scan_deepmod(df.select(F.concat_ws(" ", *map(text, cols)).alias("value")), cluster=True)


@query("select Chr, pos_c as Pos, '+' as Strand, cast(p_partkey % 4 as double) / (p_partkey % 4 + 2) as freq, p_partkey % 4 + 2 as cov, p_partkey % 4 as meth from cpg_site union all select Chr, pos_c + 1, '-', cast(p_partkey % 3 as double) / (p_partkey % 3 + p_partkey % 2), p_partkey % 3 + p_partkey % 2, p_partkey % 3 from cpg_site where p_partkey % 3 + p_partkey % 2 > 0", "cpg_site")
def scan_guppy_sites_raw(spark, sf):
    k = F.col("p_partkey")
    return R.scan_guppy_sites_raw(lines(view(spark, sf, "cpg_site"), "Chr", (F.col("pos_c") - 1).cast("string"), F.lit("CG"), (k % 4).cast("string"), (k % 3).cast("string"), F.lit("2"), (k % 2).cast("string")))


@query("select tag, Chr, start, stop, Strand from region_view where tag = 'Exons'", "region_view")
def scan_region_bed(spark, sf):
    df = view(spark, sf, "region_view").where("tag = 'Exons'")
    return R.scan_region_bed(lines(df, "Chr", (F.col("start") - 1).cast("string"), "stop", DASH, DASH, "Strand"), "Exons")


@query(f"select {SITES}, round(avg(cast({LABEL} as double)), 6) as freq, count(*) as cov, sum({LABEL}) as meth from read_call where tool = 'nanopolish' group by {SITES}", "read_call")
def scan_custom_tool(spark, sf):
    tool = R.CustomTool("mine", id=4, chr=0, pos=1, strand=2, scores=(3,), base=0)
    _, by_site = R.scan_custom_tool(lines(calls(spark, sf).where("tool = 'nanopolish'"), "Chr", POS0, "Strand", "Score", "ID"), tool)
    return by_site.withColumns(r6("freq"))


@query("select ID, haplotype from haplotag where haplotype in ('H1', 'H2')", "haplotag")
def scan_haplotag_list(spark, sf):
    df = R.columns(lines(view(spark, sf, "haplotag"), "ID", "haplotype"), "ID haplotype")
    return df.where(F.col("haplotype").isin("H1", "H2"))


# --- functions -----------------------------------------------------------------------------------


@query("select ID, Chr, Pos, Strand, tool, round(1 / (1 + exp(-Score)), 6) as p_e, round(1 / (1 + pow(2, -Score)), 6) as p_2, round(Score / ln(2), 6) as llr2 from read_call", "read_call")
def fn_llr_to_prob(spark, sf):
    x = F.col("Score")
    return calls(spark, sf).select("ID", *SITE, "tool", F.round(S.llre_to_prob(x), 6).alias("p_e"), F.round(S.llr2_to_prob(x), 6).alias("p_2"), F.round(S.llre_to_llr2(x), 6).alias("llr2"))


@query(f"select {SITES}, rep, round(log2((freq + 0.00001) / (1 - freq + 0.00001)), 6) as llr2, round(ln((freq + 0.00001) / (1 - freq + 0.00001)), 6) as llre from bs_truth", "bs_truth")
def fn_prob_to_llr2(spark, sf):
    return truth(spark, sf).select(*SITE, "rep", F.round(S.prob_to_llr2(F.col("freq")), 6).alias("llr2"), F.round(S.prob_to_llre(F.col("freq")), 6).alias("llre"))


@query(f", {UNION}, {CERTAIN} select {SITES}, y_true from certain", "bs_truth")
def fn_freq_to_label(spark, sf):
    return A.filter_certain_sites(union_truth(spark, sf, 5)).select(*SITE, S.freq_to_label(F.col("freq")).alias("y_true"))


@query(f"select ID, {SITES}, tool, {LABEL} as label from read_call", "read_call")
def fn_score_to_label(spark, sf):
    return labelled(spark, sf).select("ID", *SITE, "tool", "label")


# --- filters -------------------------------------------------------------------------------------


@query(f", {UNION} select {SITES}, round(freq, 6) as freq, cov, meth from union_truth where freq < 0.00001 or freq > 0.99999", "bs_truth")
def filter_certain_sites(spark, sf):
    return A.filter_certain_sites(union_truth(spark, sf)).withColumns(r6("freq"))


@query("select tool, ID, Chr, Pos, Strand, Score from read_call where Chr in ('chr1', 'chr3')", "read_call")
def filter_chromosomes(spark, sf):
    return A.filter_chromosomes(calls(spark, sf), ["chr1", "chr3"])


@query(f"select tool, ID, {SITES}, Score from (select *, count(*) over (partition by tool, {SITES}) as n from read_call) where n >= 10", "read_call")
def filter_min_read_cov(spark, sf):
    return A.filter_min_read_cov(calls(spark, sf), 10).select("tool", "ID", *SITE, "Score")


WIDE = f"wide as (select ID, {SITES}, " + ", ".join(f"min(case when tool = '{t}' then Score end) as {t}" for t in TOOLS) + f" from read_call group by ID, {SITES})"
INNER = " and ".join(f"{t} is not null" for t in TOOLS)


@query(f", {WIDE} select * from wide where {INNER} and abs(nanopolish) >= 2.0 and abs(megalodon) >= 1.386", "read_call")
def filter_tool_cutoffs(spark, sf):
    return A.filter_tool_cutoffs(J.join_tools(calls(spark, sf), TOOLS), {"nanopolish": 2.0, "megalodon": 1.386})


@query(f", {WIDE} select * from wide where {INNER}", "read_call")
def filter_finite(spark, sf):
    return A.filter_finite(J.join_tools(calls(spark, sf), TOOLS, "outer"), TOOLS)


@query("select * from region_view where tag in ('Exons', 'Introns') and Chr in ('chr1')", "region_view")
def facet_filter(spark, sf):
    return A.facet_filter(view(spark, sf, "region_view"), {"tag": ["Exons", "Introns"], "Chr": ["chr1"]})


@query(f"select {SITES}, case when i <= meth then 1 else 0 end as label from (select *, unnest(range(1, cov + 1)) as i from bs_truth where rep = 1)", "bs_truth")
def expand_site_to_reads(spark, sf):
    return A.expand_site_to_reads(truth(spark, sf, 1))


# --- joins ---------------------------------------------------------------------------------------


@query(f", {WIDE} select * from wide where {INNER}", "read_call")
def join_tools_inner(spark, sf):
    return J.join_tools(calls(spark, sf), TOOLS)


@query(f", {WIDE} select * from wide", "read_call")
def join_tools_outer(spark, sf):
    return J.join_tools(calls(spark, sf), TOOLS, "outer")


@query(f", {WIDE}, {UNION} select wide.*, round(freq, 6) as freq, cov from wide join union_truth using ({SITES}) where {INNER}", "read_call", "bs_truth")
def join_truth_inner(spark, sf):
    return J.join_truth(J.join_tools(calls(spark, sf), TOOLS), union_truth(spark, sf).drop("meth")).withColumns(r6("freq"))


@query(f", {UNION} select {SITES}, round(freq, 6) as freq, cov, meth from union_truth where cov >= 5", "bs_truth")
def truth_union_replicates(spark, sf):
    return union_truth(spark, sf, 5).withColumns(r6("freq"))


@query(f"select {SITES}, case when a.freq < 0.00001 then 0.0e0 else 1.0e0 end as freq, least(a.cov, b.cov) as cov from (select * from bs_truth where rep = 1) a join (select * from bs_truth where rep = 2) b using ({SITES}) where (a.freq < 0.00001 and b.freq < 0.00001) or (a.freq >= 0.9 and b.freq >= 0.9)", "bs_truth")
def truth_consensus_replicates(spark, sf):
    return J.truth_consensus_replicates(truth(spark, sf, 1), truth(spark, sf, 2))


@query(f", b as (select a.freq as f1, b.freq as f2 from (select * from bs_truth where rep = 1) a join (select * from bs_truth where rep = 2) b using ({SITES})) select count(case when f1 >= 0.9 and f2 >= 0.9 then 1 end) as meth, count(case when f1 < 0.00001 and f2 < 0.00001 then 1 end) as unmeth, count(case when not ((f1 >= 0.9 and f2 >= 0.9) or (f1 < 0.00001 and f2 < 0.00001)) then 1 end) as unused from b", "bs_truth")
def truth_consensus_counts(spark, sf):
    return J.truth_consensus_counts(truth(spark, sf, 1), truth(spark, sf, 2))


@query(f"select tool, ID, {SITES}, Score from read_call where ({SITES}) in (select {SITES} from bs_truth)", "read_call", "bs_truth")
def semi_join_truth(spark, sf):
    return J.semi_join_truth(calls(spark, sf), truth(spark, sf)).select("tool", "ID", *SITE, "Score")


MATRIX = f"matrix as (select {SITES}, freq as bs_freq, cov as bs_cov, " + ", ".join(f"{t}_freq, {t}_cov" for t in TOOLS) + f" from union_truth left join (select {SITES}, " + ", ".join(f"min(case when tool = '{t}' then freq end) as {t}_freq, min(case when tool = '{t}' then cov end) as {t}_cov" for t in TOOLS) + f" from site_calls group by {SITES}) using ({SITES}))"
ROUNDED = f"{SITES}, round(bs_freq, 6) as bs_freq, bs_cov, " + ", ".join(f"round({t}_freq, 6) as {t}_freq, {t}_cov" for t in TOOLS)


def matrix(spark, sf, joined=True):
    return J.site_matrix(site_calls(spark, sf), union_truth(spark, sf), TOOLS, joined)


@query(f", {SITE_CALLS}, {UNION}, {MATRIX} select {ROUNDED} from matrix where " + " and ".join(f"{t}_freq is not null" for t in TOOLS), "read_call", "bs_truth")
def site_matrix(spark, sf):
    return matrix(spark, sf).withColumns(r6("bs_freq", *[f"{t}_freq" for t in TOOLS]))


@query(f", {WIDE} select ID, {SITES}, nanopolish, k from wide left join (select {SITES}, min(k_mer) as k from kmer group by {SITES}) using ({SITES})", "read_call", "kmer")
def join_features_left(spark, sf):
    wide = J.join_tools(calls(spark, sf), TOOLS, "outer").select("ID", *SITE, "nanopolish")
    return J.join_features_left(wide, view(spark, sf, "kmer").withColumnRenamed("k_mer", "k"))


@query("select distinct s.Chr, s.Pos, s.Strand from site_strand s join region_view r on s.Chr = r.Chr and s.Pos between r.start and r.stop", "site_strand", "region_view")
def interval_semi_join(spark, sf):
    return J.interval_semi_join(view(spark, sf, "site_strand").select(*SITE), view(spark, sf, "region_view"))


@query("select s.Chr, s.Pos, s.Strand, tag, start, stop from site_strand s join region_view r on s.Chr = r.Chr and s.Pos between r.start and r.stop and s.Strand = r.Strand", "site_strand", "region_view")
def interval_inner_join(spark, sf):
    return J.interval_pairs(view(spark, sf, "site_strand").select(*SITE), view(spark, sf, "region_view"), strand=True)


@query(f", {UNION}, {CERTAIN}, {TAGS} select {SITES}, tag from tags", "bs_truth", "region_view")
def annotate_regions_multi(spark, sf):
    certain = A.filter_certain_sites(union_truth(spark, sf, 5)).select(*SITE)
    return J.annotate_regions_multi(certain, view(spark, sf, "region_view"))


@query(f"select r.tool, r.ID, {SITES}, r.Score, haplotype from read_call r join haplotag h on r.ID = h.ID where haplotype <> 'none'", "read_call", "haplotag")
def join_haplotype_reads(spark, sf):
    return J.join_haplotype_reads(calls(spark, sf), view(spark, sf, "haplotag"))


# --- dedup, sort, sets ---------------------------------------------------------------------------


@query(f"select tool, ID, {SITES}, min(Score) as Score from read_call group by tool, ID, {SITES}", "read_call")
def dedup_read_calls(spark, sf):
    return J.dedup_read_calls(calls(spark, sf))


@query(f"select distinct tool, ID, {SITES}, Score from read_call", "read_call")
def dedup_exact_sorted(spark, sf):
    return J.sort_distinct_natural(calls(spark, sf))


@query(f"select {SITES} from site_strand", "site_strand")
def sort_sites_natural(spark, sf):
    return J.sort_sites_natural(view(spark, sf, "site_strand").select(*SITE))


@query(f"select distinct {SITES} from read_call", "read_call")
def set_union_sites(spark, sf):
    return J.set_union_sites(calls(spark, sf))


@query(f"select {SITES} from read_call group by {SITES} having count(distinct tool) = 3", "read_call")
def set_intersect_sites(spark, sf):
    return J.set_intersect_sites(calls(spark, sf), TOOLS)


@query(f"select {SITES} from site_strand except select {SITES} from read_call", "site_strand", "read_call")
def set_except_sites(spark, sf):
    return J.set_except_sites(view(spark, sf, "site_strand"), calls(spark, sf))


@query(f", m as (select bit_or(case tool when 'nanopolish' then 1 when 'megalodon' then 2 else 4 end) as m from read_call group by {SITES}) select cast(s as int) as subset, count(m) as n_sites from (select unnest(range(1, 8)) as s) left join m on (m & s) = s group by s", "read_call")
def venn_counts(spark, sf):
    return J.venn_counts(calls(spark, sf), TOOLS)


@query(f", t as (select distinct tool, {SITES} from read_call), top as (select tool from t group by tool order by count(*) desc, tool limit 2) select cast(count(case when m = 2 then 1 end) as bigint) as joint, count(*) as union_sites from (select {SITES}, count(*) as m from t where tool in (select tool from top) group by {SITES})", "read_call")
def topk_joint_union(spark, sf):
    return J.topk_joint_union(calls(spark, sf), TOOLS, 2)


@query(f"select {SITES}, cast(cov as bigint) as cov, cast(meth as bigint) as meth, cast(floor(100 * meth / cov) as bigint) as pct, cast(least(cov, 1000) as bigint) as capped from (select {SITES}, sum(cov) as cov, sum(meth) as meth from bs_truth group by {SITES})", "bs_truth")
def union_replicate_runs(spark, sf):
    return J.union_replicate_runs(truth(spark, sf))


@query(f"select tool, ID, {SITES}, Score, k from (select *, row_number() over (partition by tool, {SITES} order by md5(concat('53:', ID)), ID, Score) as place, count(*) over (partition by tool, {SITES}) as n from (select tool, ID, {SITES}, min(Score) as Score from read_call group by tool, ID, {SITES})) join (select unnest([5, 10, 15]) as k) on place <= k where n >= 15", "read_call")
def downsample_reads(spark, sf):
    return J.downsample_reads(J.dedup_read_calls(calls(spark, sf)), 15)


@query(f"select tool, ID, {SITES}, Score from (select *, row_number() over (partition by tool, ID, {SITES} order by abs(Score) desc, Score desc) as k from read_call) where k = 1", "read_call")
def best_call_per_position(spark, sf):
    return J.best_call_per_position(calls(spark, sf))


# --- aggregation and reports ---------------------------------------------------------------------


@query(f", {SITE_CALLS} select tool, {SITES}, round(freq, 6) as freq, cov, meth from site_calls where cov >= 3", "read_call")
def agg_read_to_site(spark, sf):
    return A.agg_read_to_site(labelled(spark, sf), 3).withColumns(r6("freq"))


@query(f", {WIDE}, {UNION} select {SITES}, " + ", ".join(f"round(avg(case when {t} > 0 then 1.0e0 when {t} is not null then 0.0e0 end), 6) as {t}" for t in TOOLS) + f", round(min(freq), 6) as freq, min(cov) as cov, min(case when exists (select 1 from region_view r where r.tag = 'Promoters' and r.Chr = wide.Chr and wide.Pos between r.start and r.stop) then 'Promoters' else 'other' end) as region, count(*) as reads from wide join union_truth using ({SITES}) where {INNER} group by {SITES} having count(*) >= 3", "read_call", "bs_truth", "region_view")
def agg_read_to_site_multitool(spark, sf):
    by_site = A.agg_read_to_site_multitool(J.join_tools(calls(spark, sf), TOOLS), TOOLS)  # reads become sites before any join
    known = union_truth(spark, sf).drop("meth")
    inside = J.interval_semi_join(known.select(*SITE), view(spark, sf, "region_view").where("tag = 'Promoters'")).withColumn("region", F.lit("Promoters"))
    known = known.join(inside, SITE, "left").na.fill("other", ["region"])
    return J.join_truth(by_site, known).select(*SITE, *TOOLS, "freq", "cov", "region", "reads").withColumns(r6(*TOOLS, "freq"))


COUNTS = "select tool, tag, count(case when y_true = 1 and y_pred = 1 then 1 end) as tp, count(case when y_true = 0 and y_pred = 1 then 1 end) as fp, count(case when y_true = 1 and y_pred = 0 then 1 end) as fn, count(case when y_true = 0 and y_pred = 0 then 1 end) as tn, count(*) as calls, count(distinct case when y_true = 0 then concat_ws(' ', Chr, Pos, Strand) end) as sites_5c, count(distinct case when y_true = 1 then concat_ws(' ', Chr, Pos, Strand) end) as sites_5mc from rws group by tool, tag"
RATIOS = f"select *, cast(tp + tn as double) / calls as accuracy, coalesce(cast(tp as double) / nullif(tp + fp, 0), 0) as p_5mc, coalesce(cast(tp as double) / nullif(tp + fn, 0), 0) as r_5mc, coalesce(cast(tn as double) / nullif(tn + fn, 0), 0) as p_5c, coalesce(cast(tn as double) / nullif(tn + fp, 0), 0) as r_5c from ({COUNTS})"
F1 = f"select *, coalesce(2 * p_5mc * r_5mc / nullif(p_5mc + r_5mc, 0), 0) as f1_5mc, coalesce(2 * p_5c * r_5c / nullif(p_5c + r_5c, 0), 0) as f1_5c from ({RATIOS})"
METRICS = ["accuracy", "p_5mc", "r_5mc", "p_5c", "r_5c", "f1_5mc", "f1_5c"]


@query(f"{EVAL} select tool, tag, tp, fp, fn, tn, sites_5c, sites_5mc, sites_5c + sites_5mc as sites, fp + tn as calls_5c, tp + fn as calls_5mc, calls, " + ", ".join(f"round({m}, 6) as {m}" for m in METRICS) + f", round((p_5mc + p_5c) / 2, 6) as macro_p, round((r_5mc + r_5c) / 2, 6) as macro_r, round((f1_5mc + f1_5c) / 2, 6) as macro_f1, round(accuracy, 6) as micro_f1 from ({F1})", "read_call", "bs_truth", "region_view")
def read_level_metrics(spark, sf):
    return M.read_level_metrics(site_counts(spark, sf)).withColumns(r6(*METRICS, "macro_p", "macro_r", "macro_f1", "micro_f1"))


@query(f"{EVAL} select tool, tag, round(accuracy, 6) as accuracy, round(p_5mc, 6) as precision, round(r_5mc, 6) as recall, round(f1_5mc, 6) as f1, sites_5c + sites_5mc as bases, calls as preds, fp + tn as preds_5c, tp + fn as preds_5mc from ({F1})", "read_call", "bs_truth", "region_view")
def read_level_metrics_binary(spark, sf):
    return M.read_level_metrics_binary(site_counts(spark, sf), ("tool", "tag")).withColumns(r6("accuracy", "precision", "recall", "f1"))


@query(f"{EVAL} select tool, y_true, y_pred, count(*) as n from rws where tag = 'Genome-wide' group by tool, y_true, y_pred", "read_call", "bs_truth", "region_view")
def confusion_matrix(spark, sf):
    return M.confusion_matrix(tagged(spark, sf).where("tag = 'Genome-wide'"))


CUMULATED = "t as (select *, sum(pos) over (partition by tool, tag order by y_score desc) as tp, sum(neg) over (partition by tool, tag order by y_score desc) as fp from (select tool, tag, y_score, count(case when y_true = 1 then 1 end) as pos, count(case when y_true = 0 then 1 end) as neg from rws group by tool, tag, y_score))"


@query(f"{EVAL}, {CUMULATED} select tool, tag, round(sum(neg * (tp - cast(pos as double) / 2)) / nullif(sum(pos) * sum(neg), 0), 6) as roc_auc from t group by tool, tag", "read_call", "bs_truth", "region_view")
def roc_auc(spark, sf):
    return M.roc_auc(scored(spark, sf), ("tool", "tag"), F.col("n")).withColumns(r6("roc_auc"))


@query(f"{EVAL}, {CUMULATED} select tool, tag, round(sum(pos * cast(tp as double) / (tp + fp)) / nullif(sum(pos), 0), 6) as average_precision from t group by tool, tag", "read_call", "bs_truth", "region_view")
def average_precision(spark, sf):
    return M.average_precision(scored(spark, sf), ("tool", "tag"), F.col("n")).withColumns(r6("average_precision"))


@query(f"{EVAL}, {CUMULATED} select tool, tag, y_score, round(coalesce(cast(fp as double) / nullif(sum(neg) over (partition by tool, tag), 0), 0), 6) as fpr, round(coalesce(cast(tp as double) / nullif(sum(pos) over (partition by tool, tag), 0), 0), 6) as tpr, round(cast(tp as double) / (tp + fp), 6) as precision from t", "read_call", "bs_truth", "region_view")
def roc_curve_points(spark, sf):
    return M.curve_points(scored(spark, sf), ("tool", "tag"), F.col("n")).withColumns(r6("fpr", "tpr", "precision"))


PAIRS = f"pairs as (select tool, s.freq, u.freq as bs_freq from site_calls s join union_truth u using ({SITES}))"
CORR = "case when isnan(corr(freq, bs_freq)) then null else round(corr(freq, bs_freq), 6) end"


def pairs(spark, sf):
    return J.join_truth(site_calls(spark, sf).select("tool", *SITE, "freq"), union_truth(spark, sf).select(*SITE, F.col("freq").alias("bs_freq")))


RTAGS = f"(select distinct s.Chr, s.Pos, s.Strand, tag from site_strand s join region_view r on s.Chr = r.Chr and s.Pos between r.start and r.stop and (tag <> 'rep_SINE' or s.Strand = r.Strand) union all select {SITES}, 'Genome-wide' from site_strand)"


def student(r: str, n: str) -> str:
    """Two-sided p of r in SQL: the null density of asin(r), cos^(n - 3) over its whole integral, by Simpson's rule beyond asin |r|."""
    at = f"asin(least(abs({r}), 1))"
    return f"case when {n} > 2 then 2 * exp(lgamma(({n} - 1) / 2.0e0) - lgamma(({n} - 2) / 2.0e0)) / sqrt(pi()) * list_sum([(case when i in (0, 2000) then 1 when i % 2 = 1 then 4 else 2 end) * pow(cos({at} + i * (pi() / 2 - {at}) / 2000), {n} - 3) for i in range(2001)]) * (pi() / 2 - {at}) / 6000 end"


@query(f", {SITE_CALLS}, {UNION}, p as (select tool, Chr, Pos, Strand, s.freq, u.freq as bs_freq from site_calls s join union_truth u using ({SITES})), g as (select tool, tag, {CORR.replace('round(corr(freq, bs_freq), 6)', 'corr(freq, bs_freq)')} as r, avg((freq - bs_freq) * (freq - bs_freq)) as mse, count(*) as n from p join {RTAGS} using ({SITES}) group by tool, tag) select tool, tag, round(r, 6) as r, round(mse, 6) as mse, n, round({student('r', 'n')}, 6) as p from g", "read_call", "bs_truth", "site_strand", "region_view")
def site_correlation(spark, sf):
    both = J.join_truth(site_calls(spark, sf).select("tool", *SITE, "freq"), union_truth(spark, sf).select(*SITE, F.col("freq").alias("bs_freq")))
    return M.site_correlation(J.annotate_regions_multi(both, view(spark, sf, "region_view")), ("tool", "tag")).withColumns(r6("r", "mse", "p"))


@query(f", {SITE_CALLS}, {UNION}, {PAIRS} select tool, r, cast(rank() over (order by r desc) as int) as rank from (select tool, {CORR} as r from pairs group by tool)", "read_call", "bs_truth")
def tools_ranked_by_corr(spark, sf):
    return M.tools_ranked_by_corr(M.site_correlation(pairs(spark, sf)).withColumns(r6("r")))


FREQS = ["bs_freq", *[f"{t}_freq" for t in TOOLS]]


@query(f", {SITE_CALLS}, {UNION}, {MATRIX} " + " union all ".join(f"select '{a}' as a, '{b}' as b, round(corr({a}, {b}), 6) as r, count(case when {a} is not null and {b} is not null then 1 end) as n from matrix" for i, a in enumerate(FREQS) for b in FREQS[i + 1 :]), "read_call", "bs_truth")
def correlation_matrix(spark, sf):
    return M.correlation_matrix(matrix(spark, sf, joined=False), FREQS).withColumns(r6("r"))


@query(f", {SITE_CALLS}, {UNION}, {PAIRS}, b as (select freq, bs_freq, 0 as bin from pairs union all select freq, bs_freq, cast(greatest(1, ceil(bs_freq * 10 - 0.000000001)) as int) from pairs) select bin, count(*) as n, round(avg(abs(freq - bs_freq)), 6) as mae, round(avg(pow(freq - bs_freq, 2)), 6) as mse, round(sqrt(avg(pow(freq - bs_freq, 2))), 6) as rmse, case when var_pop(bs_freq) > 0.000000000001 then {CORR} end as r, case when var_pop(bs_freq) > 0.000000000001 then round(1 - avg(pow(freq - bs_freq, 2)) / var_pop(bs_freq), 6) end as r2 from b group by bin", "read_call", "bs_truth")
def accuracy_by_freq_bin(spark, sf):
    out = M.accuracy_by_freq_bin(pairs(spark, sf)).withColumn("r", F.when(F.col("r2").isNotNull(), F.col("r")))
    return out.withColumns(r6("mae", "mse", "rmse", "r", "r2"))


@query(f", {SITE_CALLS}, {UNION} select tool, count(*) as sites, (select count(*) from union_truth) as bs_sites, count(u.cov) as joined from site_calls s left join union_truth u using ({SITES}) group by tool", "read_call", "bs_truth")
def sites_report(spark, sf):
    return A.sites_report(site_calls(spark, sf), union_truth(spark, sf))


TAG_NAMES = ["Promoters", "Exons", "Introns", "CpG islands", "rep_SINE"]
ISLANDS = "isl as (select *, sum(case when pos_c - (prev + 2) < 10 then 0 else 1 end) over (partition by Chr order by pos_c) as run from (select *, lag(pos_c) over (partition by Chr order by pos_c) as prev from (select distinct Chr, pos_c from cpg_site)))"
C_POS = "case when Strand = '-' then Pos - 1 else Pos end"
CLASSES = (
    f"{ISLANDS}, big as (select *, count(*) over (partition by Chr, run) as size from isl), lab as (select Chr, {C_POS} as pos_c, y_true from certain), cj as (select big.*, y_true from big join lab using (Chr, pos_c) where size > 1), "
    "cc as (select distinct Chr, pos_c, min(y_true) over w = max(y_true) over w as same from cj window w as (partition by Chr, run order by pos_c range between 11 preceding and 11 following)), "
    "ctag as (select Chr, pos_c, case when size = 1 then 'Singletons' else 'Non-singletons' end as tag from big union all select Chr, pos_c, case when same then 'Concordant' else 'Discordant' end from cc)"
)


def cpg_classes(spark, sf, rep=None):
    return K.cpg_classes(view(spark, sf, "cpg_site"), certain_sites(spark, sf, rep), tile=2000)


def masked(spark, sf, sites, rep=None):
    return K.site_masks(sites, cpg_classes(spark, sf, rep), view(spark, sf, "region_view"), TAG_NAMES)


@query(f", {UNION}, {CERTAIN}, {TAGS}, {CLASSES} select tag, count(case when freq < 0.5 then 1 end) as n_5c, count(case when freq > 0.5 then 1 end) as n_5mc, count(*) as n_all from (select * from tags union all select {SITES}, tag from certain join ctag on certain.Chr = ctag.Chr and {C_POS} = pos_c) t join certain using ({SITES}) group by tag".replace(f"select {SITES}, tag from certain join ctag", "select certain.Chr, certain.Pos, certain.Strand, tag from certain join ctag"), "bs_truth", "region_view", "cpg_site")
def region_class_table(spark, sf):
    return K.region_class_table(masked(spark, sf, certain_sites(spark, sf)), TAG_NAMES)


CALLED = f"enough as (select * from site_calls where cov >= 3), called as (select distinct {SITES}, {C_POS} as pos_c from read_call), every as (select distinct s.Chr, s.Pos, s.Strand, tag from called s join region_view r on s.Chr = r.Chr and s.Pos between r.start and r.stop and (tag <> 'rep_SINE' or s.Strand = r.Strand) union all select s.Chr, s.Pos, s.Strand, tag from called s join ctag on s.Chr = ctag.Chr and s.pos_c = ctag.pos_c where tag <> 'Non-singletons')"
TOOL_LIST = ", ".join(f"'{t}'" for t in TOOLS)
NAMES = ", ".join(f"'{n}'" for n in (*K.CLASSES, *TAG_NAMES))


def _joint(name: str, first: int) -> str:
    """The rows of sites that all and any of the first tools have."""
    tools = ", ".join(f"'{t}'" for t in TOOLS[:first])
    return f"select '{name}Joined' as report, 'Total cov' as item, count(case when m = {first} then 1 end) as n from (select count(*) as m from enough where tool in ({tools}) group by {SITES}) union all select '{name}Union', 'Total cov', count(*) from (select distinct {SITES} from enough where tool in ({tools}))"


@query(
    f", {SITE_CALLS}, {UNION}, {CERTAIN}, {CLASSES}, {CALLED}, t as (select unnest([{TOOL_LIST}]) as report), parts as (select tool as report, tag as item, count(*) as n from enough join every using ({SITES}) group by tool, tag), "
    "totals as (select tool, count(*) as n from enough group by tool) "
    "select report, 'BG-Truth' as item, (select count(*) from union_truth where cov >= 5) as n from t "
    "union all select tool, 'Total', count(*) from site_calls group by tool union all select tool, 'Total cov', n from totals union all select tool, 'Calls', count(*) from read_call group by tool "
    f"union all select tool, 'Joined', count(*) from enough join union_truth u using ({SITES}) where u.cov >= 5 group by tool "
    f"union all select t.report, i.item, case when i.item = 'Non-singletons' then totals.n - coalesce(s.n, 0) else coalesce(p.n, 0) end from t cross join (select unnest([{NAMES}]) as item) i join totals on totals.tool = t.report left join parts p on p.report = t.report and p.item = i.item left join parts s on s.report = t.report and s.item = 'Singletons' "
    f"union all {_joint('', 3)} union all {_joint('TOP2 ', 2)} union all {_joint('TOP3 ', 3)}",
    "read_call", "bs_truth", "region_view", "cpg_site",
)
def coverage_summary(spark, sf):
    sites = K.tool_sites(calls(spark, sf), union_truth(spark, sf), TOOLS)
    return K.coverage_summary(masked(spark, sf, sites), TOOLS, TAG_NAMES, (2, 3))


@query(f", {UNION}, {CERTAIN}, {CLASSES} select tag as class, count(case when y_true = 0 then 1 end) as n_5c, count(case when y_true = 1 then 1 end) as n_5mc from certain join ctag on certain.Chr = ctag.Chr and {C_POS} = pos_c where tag in ('Concordant', 'Discordant') group by tag", "bs_truth", "cpg_site")
def concordance_class_counts(spark, sf):
    return K.concordance_counts(certain_sites(spark, sf), cpg_classes(spark, sf))


@query(f"select concat('rep', cast(rep as string)) as dataset, tag, count(case when cov >= 3 then 1 end) as cov_ge_3, count(case when cov >= 10 then 1 end) as cov_ge_10, count(*) as total from bs_truth join {RTAGS} using ({SITES}) group by rep, tag", "bs_truth", "site_strand", "region_view")
def raw_coverage_by_region(spark, sf):
    rows = truth(spark, sf).select(*SITE, "cov", F.concat(F.lit("rep"), F.col("rep").cast("string")).alias("dataset"))
    return A.raw_coverage_by_region(J.annotate_regions_multi(rows, view(spark, sf, "region_view")), (3, 10))


@query(f", {SITE_CALLS} select tool, bases, calls, positive, called, calls - positive as negative, round(positive / calls, 6) as ratio, round(called / bases, 6) as recall, case when called > 0 then 1.0e0 else 0.0e0 end as precision from (select tool, count(*) as bases, cast(sum(cov) as bigint) as calls, cast(sum(meth) as bigint) as positive, count(case when freq >= 0.2 then 1 end) as called from site_calls group by tool)", "read_call")
def positive_control_eval(spark, sf):
    return A.positive_control_eval(site_calls(spark, sf)).withColumns(r6("ratio", "recall"))


@query(f"select {SITES}, round(avg(case when label = 0 then 1.0e0 else 0 end), 6) as p_5c, round(avg(case when label = 1 then 1.0e0 else 0 end), 6) as p_5mc, round(avg(case when label = 2 then 1.0e0 else 0 end), 6) as p_5hmc, count(*) as cov from (select *, case when Score > 2 then 2 when Score > 0.00001 then 1 else 0 end as label from read_call) group by {SITES}", "read_call")
def agg_three_class_site(spark, sf):
    three = calls(spark, sf).withColumn("label", F.when(F.col("Score") > 2, 2).when(F.col("Score") > 1e-5, 1).otherwise(0))
    return A.agg_three_class_site(three).withColumns(r6("p_5c", "p_5mc", "p_5hmc"))


@query(f", {SITE_CALLS}, {UNION}, {PAIRS}, x as (select *, unnest(['lt_0.05', 'lt_0.10', 'gt_0.2', 'gt_0.4']) as part from pairs), g as (select tool, part, corr(freq, bs_freq) as r, avg(pow(freq - bs_freq, 2)) as mse, count(*) as n from x where case part when 'lt_0.05' then abs(freq - bs_freq) < 0.05 when 'lt_0.10' then abs(freq - bs_freq) < 0.10 when 'gt_0.2' then abs(freq - bs_freq) > 0.2 else abs(freq - bs_freq) > 0.4 end group by tool, part) select tool, part, round(case when isnan(r) then null else r end, 6) as r, round(mse, 6) as mse, n, round(case when isnan(r) then null else {student('r', 'n')} end, 6) as p from g", "read_call", "bs_truth")
def agreement_partitions(spark, sf):
    return A.agreement_partitions(pairs(spark, sf)).withColumns(r6("r", "mse", "p"))


@query(f", {SITE_CALLS}, m as (select max(cov) + 1 as top from site_calls) select tool, 'freq' as kind, cast(least(floor(freq * 10 + 0.000000001), 9) as int) as bin, count(*) as n from site_calls group by 1, 3 union all select tool, 'cov', cast(least(floor(cov * 10.0e0 / top), 9) as int), count(*) from site_calls, m group by 1, 3 union all select tool, 'sites', null, count(*) from site_calls group by 1", "read_call")
def histogram_freq_cov(spark, sf):
    return A.histogram_freq_cov(site_calls(spark, sf))


@query("select dataset, count(*) as reads, count(case when sequence_length > 2000 then 1 end) as long_reads, round(count(case when sequence_length > 2000 then 1 end) / count(*), 6) as ratio from seq_summary group by dataset", "seq_summary")
def long_read_portion(spark, sf):
    return A.long_read_portion(view(spark, sf, "seq_summary"), 2000).withColumns(r6("ratio"))


@query(f", a as (select *, concat(Chr, ':', cast(Pos as string), Strand) as site from (select *, {LABEL} as label from read_call)), f as (select 'label' as facet, cast(label as string) as value, site from a union all select 'tool', tool, site from a union all select 'total', 'all', site from a) select facet, value, count(*) as n, count(distinct site) as sites, round(count(*) / (select count(*) from a), 6) as share, round(count(distinct site) / (select count(distinct site) from a), 6) as site_share from f group by facet, value", "read_call")
def class_balance(spark, sf):
    return A.class_balance(labelled(spark, sf), ["label", "tool"]).withColumns(r6("share", "site_share"))


@query("select facet, value, count(*) as n from (select 'tag' as facet, tag as value from region_view union all select 'Chr', Chr from region_view union all select 'Strand', Strand from region_view) group by facet, value", "region_view")
def facet_counts(spark, sf):
    return A.facet_counts(view(spark, sf, "region_view"), ["tag", "Chr", "Strand"])


@query("select tag, round(cast(sum(n) over () as double) / (count(*) over () * n), 6) as weight from (select tag, count(*) as n from region_view group by tag)", "region_view")
def region_sample_weights(spark, sf):
    return A.region_sample_weights(view(spark, sf, "region_view")).withColumns(r6("weight"))


# --- positions -----------------------------------------------------------------------------------


@query(f", {ISLANDS} select Chr, min(pos_c) as start, max(pos_c) + 1 as stop, count(*) as cpgs, count(*) = 1 as singleton from isl group by Chr, run", "cpg_site")
def singleton_islands(spark, sf):
    return P.singleton_islands(view(spark, sf, "cpg_site"), tile=2000)


@query(f", {UNION}, {CERTAIN}, {ISLANDS}, big as (select *, count(*) over (partition by Chr, run) as n from isl), c as (select Chr, case when Strand = '-' then Pos - 1 else Pos end as pos_c, Strand, y_true as label, cov from certain), j as (select c.*, run from c join big on c.Chr = big.Chr and c.pos_c = big.pos_c where n > 1) select Chr, pos_c, Strand, label, cov, min(label) over w = max(label) over w as concordant from j window w as (partition by Chr, run order by pos_c range between 11 preceding and 11 following)", "bs_truth", "cpg_site")
def concordance_classes(spark, sf):
    return K.concordance_classes(certain_sites(spark, sf), cpg_classes(spark, sf))


@query("select Chr, Strand, min(start) as start, max(stop) as stop from (select *, sum(case when start <= reach then 0 else 1 end) over (partition by Chr, Strand order by start, stop rows unbounded preceding) as run from (select *, max(stop) over (partition by Chr, Strand order by start, stop rows between unbounded preceding and 1 preceding) as reach from region_view)) group by Chr, Strand, run", "region_view")
def merge_intervals(spark, sf):
    return P.merge_intervals(view(spark, sf, "region_view"), tile=2000)


@query("select Chr, Strand, at as start, stop, depth from (select *, sum(d) over (partition by Chr, Strand order by at) as depth, lead(at) over (partition by Chr, Strand order by at) as stop from (select Chr, Strand, at, sum(d) as d from (select Chr, Strand, start0 as at, 1 as d from alignment union all select Chr, Strand, end0, -1 from alignment) group by Chr, Strand, at having sum(d) <> 0)) where depth > 0".replace(" at,", " place,").replace(" at ", " place ").replace(" at)", " place)").replace("(at)", "(place)"), "alignment")
def genome_coverage(spark, sf):
    return P.genome_coverage(view(spark, sf, "alignment"), tile=2000)


@query("select ID, Chr, Strand, start0, cast(sum(case when start0 - prev < 300 then 0 else 1 end) over (partition by ID, Chr, Strand order by start0) as bigint) as session from (select *, lag(start0) over (partition by ID, Chr, Strand order by start0) as prev from (select distinct ID, Chr, Strand, Pos - 1 as start0 from read_call))", "read_call")
def read_sessions(spark, sf):
    df = calls(spark, sf).select("ID", "Chr", "Strand", (F.col("Pos") - 1).alias("start0")).distinct()
    return P.read_sessions(df, 300)


@query("select Chr, chunk_start + i - 1 as start from (select Chr, chunk_start, s, unnest(range(1, length(s))) as i from (select c.Chr, c.chunk_start, concat(c.seq, coalesce(substr(n.seq, 1, 1), '')) as s from genome_chunk c left join genome_chunk n on c.Chr = n.Chr and n.chunk_start = c.chunk_start + 64)) where substr(s, cast(i as int), 2) = 'CG'", "genome_chunk")
def cpg_scan_genome(spark, sf):
    return P.cpg_scan_genome(view(spark, sf, "genome_chunk"))


BINS = ", ".join(f"case when m > 0 then round_even(cast(h{k} as double) / m, 3) else 0.0e0 end as h{k}" for k in range(11))
HITS = ", ".join(f"count(case when o.bin = {k} then 1 end) as h{k}" for k in range(11))


@query(f", {UNION}, one as (select Chr, Pos, cast(floor(coalesce(min(case when Strand = '+' then freq end), min(freq)) / 0.1 + 0.5) as int) as bin from union_truth group by Chr, Pos), n as (select u.Chr, u.Pos, u.Strand, count(o.Pos) as m, {HITS} from union_truth u left join one o on u.Chr = o.Chr and o.Pos between u.Pos - 25 and u.Pos + 25 and o.Pos <> u.Pos and o.Pos <> u.Pos + case when u.Strand = '+' then 1 else -1 end group by u.Chr, u.Pos, u.Strand) select u.Chr, u.Pos, u.Strand, round(u.freq, 6) as freq, round(coalesce(p.freq, 0), 6) as partner_freq, m as neighbors, {BINS} from union_truth u join n using (Chr, Pos, Strand) left join union_truth p on p.Chr = u.Chr and p.Strand <> u.Strand and p.Pos = u.Pos + case when u.Strand = '+' then 1 else -1 end", "bs_truth")
def cluster_neighbor_features(spark, sf):
    return P.cluster_neighbor_features(union_truth(spark, sf).select(*SITE, "freq"), tile=2000).withColumns(r6("freq", "partner_freq"))


# --- haplotypes ----------------------------------------------------------------------------------

TAGGED = "tagged as (select ID, b.Chr, b.pos0, base, qual, mapq, case when base = case when gt = '1|0' then alt else ref end then 1 else 2 end as hp from read_base b join snv s on b.Chr = s.Chr and b.pos0 = s.pos0 where mapq >= 10 and (flag & 2048) = 0 and base in (ref, alt) and gt in ('1|0', '0|1'))"


@query(f", {TAGGED} select * from tagged", "read_base", "snv")
def tag_reads_with_snvs(spark, sf):
    return H.tag_reads_with_snvs(view(spark, sf, "read_base"), view(spark, sf, "snv"), 10)


@query(f", {TAGGED} select ID, hp, count(*) as snvs, string_agg(concat(cast(pos0 as string), ':', cast(qual as string)), ',' order by pos0, qual) as evidence from tagged group by ID, hp", "read_base", "snv")
def read_haplotype_evidence(spark, sf):
    return H.read_haplotype_evidence(H.tag_reads_with_snvs(view(spark, sf, "read_base"), view(spark, sf, "snv"), 10))


HP = f"{TAGGED}, c as (select ID, " + ", ".join(f"count(case when hp = {k} then 1 end) as c{k}, coalesce(avg(case when hp = {k} then qual end), 0) as m{k}, count(case when hp = {k} and qual >= 20 then 1 end) as g{k}" for k in (1, 2)) + " from tagged where qual >= 7 group by ID), assigned as (select ID, case " + " ".join(f"when c{a} > c{b} and c{b} <= 0.75 * c{a} and c{a} >= 2 and (m{a} >= m{b} or g{a} >= g{b}) then {a}" for a, b in ((1, 2), (2, 1))) + " end as hp from c)"


@query(f", {HP} select * from assigned", "read_base", "snv")
def assign_haplotype(spark, sf):
    return H.assign_haplotype(H.tag_reads_with_snvs(view(spark, sf, "read_base"), view(spark, sf, "snv"), 10))


@query(f", {HP}, best as (select tool, ID, {SITES}, Score from (select *, row_number() over (partition by tool, ID, {SITES} order by abs(Score) desc, Score desc) as k from read_call) where k = 1) select r.tool, r.ID, r.Chr, r.Pos, r.Strand, r.Score, a.hp from best r join assigned a on r.ID = a.ID join alignment x on r.ID = x.ID and r.Chr = x.Chr and r.Strand = x.Strand where hp is not null and Pos - 1 >= start0 and Pos - 1 <= end0", "read_base", "snv", "read_call", "alignment")
def phased_calls(spark, sf):
    assigned = H.assign_haplotype(H.tag_reads_with_snvs(view(spark, sf, "read_base"), view(spark, sf, "snv"), 10))
    return H.phased_calls(calls(spark, sf), assigned, view(spark, sf, "alignment"))


@query(f"select r.tool, r.ID, r.Chr, r.Pos, r.Strand, r.Score from (select *, row_number() over (partition by tool, ID, {SITES} order by abs(Score) desc, Score desc) as k from read_call) r join alignment x on r.ID = x.ID and r.Chr = x.Chr and r.Strand = x.Strand where k = 1 and (flag & 3844) = 0 and mapq >= 20 and Pos - 1 >= start0 and Pos - 1 <= end0", "read_call", "alignment")
def unphased_calls(spark, sf):
    return H.unphased_calls(calls(spark, sf), view(spark, sf, "alignment"))


HPSITE = f"hps as (select haplotype, {SITES}, avg(cast({LABEL} as double)) as freq, count(*) as cov, sum({LABEL}) as meth from read_call r join haplotag h on r.ID = h.ID where haplotype <> 'none' and tool = 'megalodon' group by haplotype, {SITES})"


def hp_sites(spark, sf):
    return H.hp_site_freq(J.join_haplotype_reads(labelled(spark, sf).where("tool = 'megalodon'"), view(spark, sf, "haplotag")))


@query(f", {HPSITE} select haplotype, {SITES}, round(freq, 6) as freq, cov, meth from hps", "read_call", "haplotag")
def hp_site_freq(spark, sf):
    return hp_sites(spark, sf).withColumns(r6("freq"))


@query(f", {HPSITE} select {SITES}, round(f1, 6) as H1_freq, round(f2, 6) as H2_freq, c1 as H1_cov, c2 as H2_cov, round(f1 - f2, 6) as diff from (select {SITES}, min(case when haplotype = 'H1' then freq end) as f1, min(case when haplotype = 'H2' then freq end) as f2, min(case when haplotype = 'H1' then cov end) as c1, min(case when haplotype = 'H2' then cov end) as c2 from hps group by {SITES})", "read_call", "haplotag")
def hp_allele_diff(spark, sf):
    return H.hp_allele_diff(hp_sites(spark, sf)).withColumns(r6("H1_freq", "H2_freq", "diff"))


@query("select count(*) as total, count(case when ok then 1 end) as passing, count(case when ok and haplotype in ('H1', 'H2') then 1 end) as tagged, count(case when ok and haplotype = 'H1' then 1 end) as h1, count(case when ok and haplotype = 'H2' then 1 end) as h2 from (select *, (flag & 3844) = 0 and mapq >= 20 as ok from alignment) a left join haplotag h on a.ID = h.ID", "alignment", "haplotag")
def alignment_filter_counts(spark, sf):
    return H.alignment_filter_counts(view(spark, sf, "alignment"), view(spark, sf, "haplotag"))


# --- exports -------------------------------------------------------------------------------------


BED8 = "Chr string, start bigint, stop bigint, name string, score string, Strand string, freq double, cov bigint"


def sorted_file(spark, df, schema: str, distinct: bool = False):
    """df through a sorted, compressed text and back; distinct: each row once."""
    path = folder(spark)
    X.write_text(df, path, sort=True, distinct=distinct)
    return X.read_sorted(spark, path, schema)


@query(f"select distinct ID, {SITES}, Score from read_call where tool = 'nanopolish'", "read_call")
def export_read_unified(spark, sf):
    return sorted_file(spark, X.export_read_unified(calls(spark, sf).where("tool = 'nanopolish'"), dedup=False), "ID string, Chr string, Pos bigint, Strand string, Score double", distinct=True)


@query(f", {UNION} select Chr, Pos - 1 as start, Pos as stop, '.' as name, '.' as score, Strand, round(freq, 6) as freq, cov from union_truth", "bs_truth")
def export_truth_unified(spark, sf):
    return sorted_file(spark, X.export_site_unified(union_truth(spark, sf)), BED8).withColumns(r6("freq"))


@query(f", {SITE_CALLS} select Chr, Pos - 1 as start, Pos as stop, '.' as name, '.' as score, Strand, round(freq, 6) as freq, cov from site_calls where tool = 'megalodon'", "read_call")
def export_site_unified(spark, sf):
    return sorted_file(spark, X.export_site_unified(site_calls(spark, sf).where("tool = 'megalodon'")), BED8).withColumns(r6("freq"))


@query("select Chr, Pos - 1 as start, Pos as stop, '.' as name, '.' as score, Strand from site_strand", "site_strand")
def export_single_site_bed(spark, sf):
    return X.export_single_site_bed(view(spark, sf, "site_strand"))


@query(f"select {SITES}, string_agg(cast({LABEL} as string), ',' order by {LABEL}) as labels, count(*) as cov from read_call where tool = 'nanopolish' group by {SITES}", "read_call")
def export_read_preds(spark, sf):
    return X.export_read_preds(labelled(spark, sf).where("tool = 'nanopolish'"))


@query("select distinct Chr, Pos - 1 as start, Pos as stop, cov as signal from bs_truth where rep = 1 and cov >= 4", "bs_truth")
def export_bedgraph(spark, sf):
    return X.export_bedgraph(truth(spark, sf, 1), "cov", 4)


@query("select concat(Chr, '.', cast(Pos as string)) as chrBase, Chr, Pos as base, case when Strand = '+' then 'F' else 'R' end as strand, cov as coverage, round(100 * freq, 6) as freqC, round(100 - 100 * freq, 6) as freqT from bs_truth where rep = 1", "bs_truth")
def export_methylkit(spark, sf):
    return X.export_methylkit(truth(spark, sf, 1)).withColumns(r6("freqC", "freqT"))


@query("select Chr, Pos - 1 as start, Pos as stop, '.' as name, cast(floor(freq * 100 + 0.000000001) as bigint) as score, Strand from bs_truth where rep = 1", "bs_truth")
def export_ucsc_bed(spark, sf):
    return X.export_ucsc_bed(truth(spark, sf, 1))


@query("select distinct concat(Chr, '_', cast(Pos as string), '_', Strand) as key from read_call", "read_call")
def export_keyset(spark, sf):
    return sorted_file(spark, X.export_keyset(calls(spark, sf)), "key string")


@query("select Chr, Pos as pos, cov as N, meth as X from bs_truth where rep = 1 and cov >= 2", "bs_truth")
def export_dss_input(spark, sf):
    return X.export_dss_input(truth(spark, sf, 1), 2)


@query("select Chr, case when Strand = '-' then Pos - 1 else Pos end as pos, cast(sum(cov) as bigint) as N, cast(sum(meth) as bigint) as X from bs_truth where rep = 1 group by 1, 2", "bs_truth")
def export_dss_input_stranded(spark, sf):
    return X.export_dss_input_stranded(truth(spark, sf, 1))
