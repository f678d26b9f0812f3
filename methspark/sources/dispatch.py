"""Calls and truth by the name of their format."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.sites import expand_site_to_reads
from . import scans as R
from . import tables as T

#: Formats of calls by read, with the names of their cutoffs, and of sites; names are looked up in any case.
READ_SCANS = {
    "nanopolish": (R.scan_nanopolish, ("cutoff",)),
    "deepsignal": (R.scan_deepsignal, ("cutoff", "cutoff")),
    "tombo": (R.scan_tombo, ("low", "high")),
    "megalodon": (R.scan_megalodon, ("cutoff",)),
    "megalodon.zw": (partial(R.scan_megalodon, reordered=True), ("cutoff",)),
    "guppy.gcf52ref": (R.scan_gcf52ref, ("low", "high")),
    "consensus": (R.scan_consensus_reads, ()),
    "meteore": (partial(R.scan_consensus_reads, forest=True), ()),
    "uniread": (R.scan_uniread, ("low", "high")),
}
SITE_SCANS = {
    "deepmod": T.scan_deepmod_auto,
    "deepmod.c": R.scan_deepmod,
    "deepmod.cluster": partial(R.scan_deepmod, cluster=True),
    "guppy": R.scan_guppy_sites_raw,
    "guppy.zw": T.scan_guppy_sites_pre,
    "unisite": R.scan_unisite,
}
#: Tools that users declared, by name.
CUSTOM_TOOLS: dict[str, R.CustomTool] = {}
TRUTH_SCANS = {"encode": R.scan_bs_encode, "bismark": R.scan_bs_bismark, "5hmc": R.scan_bs_5hmc, "unisite": R.scan_unisite}


def register_custom_tool(tool: R.CustomTool) -> None:
    """From now on the tool's name is a format that read_calls_by_encode reads; a name that is a format already is an error."""
    name = tool.name.lower()
    if name in READ_SCANS or name in SITE_SCANS:
        raise ValueError(f"{tool.name} is a format of its own")
    CUSTOM_TOOLS[name] = tool


def read_calls_by_encode(spark: SparkSession, spec: str, chrs=None, site_level: bool = False) -> DataFrame:
    """`tool:encode:path[:c0[:c1]]` to calls with the tool's name; site formats become pseudo reads with score 1 or 0, or stay sites if asked."""
    parts = spec.split(":")
    cutoffs: list[float] = []
    while len(parts) > 3 and len(cutoffs) < 2 and parts[-1].replace(".", "", 1).lstrip("-").isdigit():
        cutoffs.insert(0, float(parts.pop()))
    tool, encode, path = parts[0], parts[1].lower(), ":".join(parts[2:])
    lines = spark.read.text(path)
    if encode in SITE_SCANS:
        sites = R.unique_sites(SITE_SCANS[encode](lines, chrs))
        if site_level:
            return sites.withColumn("tool", F.lit(tool))
        return expand_site_to_reads(sites).withColumns({"Score": F.col("label").cast("double"), "tool": F.lit(tool)})
    if encode in CUSTOM_TOOLS:
        calls, sites = R.scan_custom_tool(lines, CUSTOM_TOOLS[encode], chrs)
        return (sites if site_level else calls).withColumn("tool", F.lit(tool))
    scan, names = READ_SCANS[encode]
    if names == ("cutoff", "cutoff"):
        given = {"cutoff": tuple(cutoffs)} if cutoffs else {}
    else:
        given = dict(zip(names, cutoffs, strict=False))
    return scan(lines, chrs, **given).withColumn("tool", F.lit(tool))


def read_truth_by_encode(spark: SparkSession, spec: str, chrs=None, min_cov: int = 1) -> DataFrame:
    """`encode:path[;path]` to one table with the replicate's number."""
    encode, _, paths = spec.partition(":")
    found = paths.split(";")
    if len(found) > 2:
        raise ValueError("at most two replicates")
    out = None
    for k, p in enumerate(found, 1):
        own = TRUTH_SCANS[encode.lower()](spark.read.text(p), chrs, min_cov).withColumn("rep", F.lit(k))
        out = own if out is None else out.unionByName(own)
    return out
