"""Domain views derived from the given tables, as SQL that Spark and DuckDB read alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("part", "lineitem", "orders", "supplier", "customer", "documents", "events", "nation", "region")
SITE = "Chr, Pos, Strand"

_SCORES = {
    "nanopolish": ("1 + q % 40", "(q * 7 + l_suppkey) % 10 = 0", "(l_orderkey + q) % 8 <> 0"),
    "megalodon": ("1 + (q * 3 + l_suppkey) % 32", "(q * 3 + l_orderkey) % 12 = 0", "(l_orderkey + q) % 9 <> 0"),
    "deepsignal": ("1 + (q * 5 + l_suppkey) % 48", "(q * 11 + l_partkey) % 15 = 0", "(l_orderkey + q) % 7 <> 0"),
}

VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "cpg_site": ((), """select p_partkey, concat('chr', cast(1 + p_partkey % 3 as string)) as Chr, 1001 + kp * 16 + (kp * kp) % 13 as pos_c
        from (select p_partkey, cast(floor(p_partkey / 3) as bigint) as kp from part)"""),
    "site_strand": (("cpg_site",), "select p_partkey, Chr, pos_c, 0 as s, pos_c as Pos, '+' as Strand from cpg_site union all select p_partkey, Chr, pos_c, 1, pos_c + 1, '-' from cpg_site"),
    "bs_truth": (("site_strand",), """select Chr, Pos, Strand, rep, cov, meth, cast(meth as double) / cov as freq from (
        select Chr, Pos, Strand, rep, cov, case when p_partkey % 5 = 0 then 0 when p_partkey % 5 = 1 then cov else (p_partkey * 3 + s) % (cov + 1) end as meth from (
        select *, 1 as rep, 1 + (p_partkey * 7 + s) % 12 as cov from site_strand where p_partkey % 11 <> 0
        union all select *, 2, 1 + (p_partkey * 5 + s) % 9 from site_strand where p_partkey % 13 <> 0))"""),
    "call_base": ((), """select *, case when l_partkey % 5 = 0 then -1 when l_partkey % 5 = 1 then 1 when (l_orderkey + l_linenumber) % 3 = 0 then 1 else -1 end as dir,
        cast(l_orderkey as string) as ID, concat('chr', cast(1 + l_partkey % 3 as string)) as Chr,
        1001 + kl * 16 + (kl * kl) % 13 + case when l_linenumber % 2 = 0 then 1 else 0 end as Pos, case when l_linenumber % 2 = 0 then '-' else '+' end as Strand
        from (select l_orderkey, l_partkey, l_suppkey, l_linenumber, cast(l_quantity as bigint) as q, cast(floor(l_partkey / 3) as bigint) as kl from lineitem)"""),
    "read_call": (("call_base",), " union all ".join(
        f"select '{tool}' as tool, ID, Chr, Pos, Strand, case when {flip} then -1 else 1 end * dir * cast({size} as double) / 8 as Score from call_base where {there}" for tool, (size, flip, there) in _SCORES.items())),
    "region_view": ((), """select case s_nationkey % 5 when 0 then 'Promoters' when 1 then 'Exons' when 2 then 'Introns' when 3 then 'CpG islands' else 'rep_SINE' end as tag,
        concat('chr', cast(1 + s_suppkey % 3 as string)) as Chr, 1000 + s_suppkey * 97 as start, 1060 + s_suppkey * 97 + (s_suppkey * 7) % 80 as stop,
        case when s_suppkey % 2 = 0 then '+' else '-' end as Strand from supplier"""),
    "alignment": ((), """select cast(o_orderkey as string) as ID, concat('chr', cast(1 + o_custkey % 3 as string)) as Chr, 1000 + (o_orderkey * 37) % 10600 as start0,
        1200 + (o_orderkey * 37) % 10600 + (o_custkey * 13) % 800 as end0, case when o_orderkey % 2 = 0 then '+' else '-' end as Strand, o_orderkey % 61 as mapq,
        16 * (o_orderkey % 2) + case when o_orderkey % 17 = 0 then 256 else 0 end + case when o_orderkey % 19 = 0 then 2048 else 0 end as flag from orders"""),
    "haplotag": ((), "select cast(o_orderkey as string) as ID, case o_orderkey % 3 when 0 then 'H1' when 1 then 'H2' else 'none' end as haplotype from orders"),
    "snv": ((), """select s_suppkey, concat('chr', cast(1 + s_suppkey % 3 as string)) as Chr, 1000 + s_suppkey * 11 as pos0, substr('ACGT', cast(1 + s_suppkey % 4 as int), 1) as ref,
        substr('ACGT', cast(1 + (s_suppkey + 1) % 4 as int), 1) as alt, case when s_suppkey % 10 = 7 then '1|1' when s_suppkey % 10 = 3 then '0/1' when s_suppkey % 2 = 0 then '1|0' else '0|1' end as gt from supplier"""),
    "read_base": (("snv",), """select cast(l_orderkey as string) as ID, Chr, pos0, case when ((l_orderkey % 3 = 0) = (gt = '1|0')) <> (l_partkey % 10 = 0) then alt else ref end as base,
        l_partkey % 41 as qual, l_orderkey % 61 as mapq, case when l_orderkey % 19 = 0 then 2048 else 0 end as flag from lineitem join snv on l_suppkey = s_suppkey"""),
    "kmer": (("cpg_site",), "select Chr, pos_c as Pos, '+' as Strand, translate(substr(md5(cast(p_partkey as string)), 1, 17), '0123456789abcdef', 'ACGTACGTACGTACGT') as k_mer from cpg_site"),
    "genome_chunk": ((), """select concat('chr', cast(1 + p_partkey % 3 as string)) as Chr, cast(floor(p_partkey / 3) as bigint) * 64 as chunk_start,
        translate(concat(md5(cast(p_partkey as string)), md5(cast(p_partkey + 1000003 as string))), '0123456789abcdef', 'ACGTACGTACGTACGT') as seq from part"""),
    "seq_summary": ((), "select source as dataset, cast(doc_id as string) as read_id, n_chars as sequence_length from documents"),
}


def ctes(*names: str) -> str:
    """The views and what they need, as the head of a query."""
    order: list[str] = []

    def add(n: str) -> None:
        if n not in order:
            for d in VIEWS[n][0]:
                add(d)
            order.append(n)

    for n in names:
        add(n)
    return "with " + ", ".join(f"{n} as ({VIEWS[n][1]})" for n in order)


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    sql = f"{ctes(name)} select * from {name}"
    for t in TABLES:
        if f" {t}" in sql:
            spark.read.parquet(f"{sf_dir}/{t}.parquet").createOrReplaceTempView(t)
    return spark.sql(sql)
