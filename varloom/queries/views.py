"""The genomic projection of the synthetic tables, in SQL that Spark and DuckDB both read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BASE = ("part", "supplier", "lineitem", "events", "customer", "embeddings", "nation", "region", "orders")

VIEWS = {
    "v_sites": """
SELECT p_partkey AS site_id,
       CASE WHEN p_partkey % 25 < 22 THEN 'chr' || CAST(p_partkey % 25 + 1 AS VARCHAR(4))
            WHEN p_partkey % 25 = 22 THEN 'chrX' WHEN p_partkey % 25 = 23 THEN 'chrY' ELSE 'chrM' END AS contig,
       CAST(1000 + p_partkey * 37 AS INT) AS position,
       substr('ACGT', p_size % 4 + 1, 1) || CASE WHEN p_partkey % 5 = 0 THEN 'AC' ELSE '' END AS ref,
       substr('CGTA', p_size % 4 + 1, 1) || CASE WHEN p_partkey % 7 = 0 THEN 'GT' ELSE '' END AS alt
FROM part""",
    "v_samples": "SELECT s_suppkey AS col_idx, 'S' || CAST(s_suppkey AS VARCHAR(12)) AS s, s_nationkey AS dataset_id FROM supplier",
    "v_entries": """
SELECT site_id, s, n_alt, CASE WHEN n_alt IS NULL THEN NULL ELSE gq END AS gq, dp, ad_ref, ad_alt FROM (
SELECT l_partkey AS site_id, 'S' || CAST(l_suppkey AS VARCHAR(12)) AS s,
       CASE WHEN (l_partkey + 3 * l_suppkey) % 15 = 0 THEN NULL
            WHEN MAX(l_returnflag) = 'A' THEN 1 WHEN MAX(l_returnflag) = 'R' THEN 2 ELSE 0 END AS n_alt,
       CAST(LEAST(99, MAX(l_quantity) * 2) AS INT) AS gq,
       CASE WHEN MIN(l_linenumber) = 7 THEN NULL ELSE CAST(MIN(l_linenumber) * 6 + MAX(l_linenumber) AS INT) END AS dp,
       CAST(MIN(l_linenumber) * 3 AS INT) AS ad_ref, CAST(MAX(l_linenumber) - MIN(l_linenumber) + 1 AS INT) AS ad_alt
FROM lineitem GROUP BY l_partkey, l_suppkey) t""",
    "v_ref_blocks": """
SELECT s, start_pos, CAST(CASE WHEN nxt IS NOT NULL AND nxt - 1 < want THEN nxt - 1 ELSE want END AS INT) AS end_pos, gq FROM (
 SELECT 'U' || CAST(user_id AS VARCHAR(12)) AS s, start_pos, start_pos + len AS want, gq,
        LEAD(start_pos) OVER (PARTITION BY user_id ORDER BY start_pos) AS nxt FROM (
   SELECT user_id, CAST(event_id * 50 AS INT) AS start_pos, MAX(CAST(floor(value * 20) AS INT)) AS len, MAX(CAST(event_id % 99 AS INT)) AS gq
   FROM events GROUP BY user_id, event_id) a) b""",
    "v_csq": """
SELECT l_partkey AS site_id, 'ENST' || CAST(l_suppkey AS VARCHAR(12)) AS transcript_id,
       'ENSG' || CAST(l_suppkey % 17 AS VARCHAR(12)) AS gene_id,
       CASE MIN(l_linenumber) WHEN 1 THEN 'stop_gained' WHEN 2 THEN 'missense_variant' WHEN 3 THEN 'synonymous_variant'
            WHEN 4 THEN '5_prime_UTR_variant' WHEN 5 THEN 'intron_variant' WHEN 6 THEN 'upstream_gene_variant' ELSE 'unlisted_term' END AS term1,
       CASE MAX(l_linenumber) WHEN 1 THEN NULL WHEN 2 THEN 'splice_region_variant' WHEN 3 THEN NULL
            WHEN 4 THEN '3_prime_UTR_variant' WHEN 5 THEN 'frameshift_variant' ELSE 'downstream_gene_variant' END AS term2,
       CASE MAX(l_returnflag) WHEN 'A' THEN 'protein_coding' WHEN 'N' THEN 'lncRNA' ELSE NULL END AS biotype,
       CASE WHEN MIN(l_linestatus) = 'F' THEN 1 ELSE NULL END AS canonical
FROM lineitem GROUP BY l_partkey, l_suppkey""",
    "v_ref_lookup": """
SELECT (c_custkey * 2) % 1000 AS site_id, c_mktsegment AS clin_sig, CAST(floor(c_acctbal) AS INT) AS allele_id,
       CAST(c_custkey % 5 AS INT) AS gold_stars, c_custkey AS pick_order FROM customer""",
    "v_multi": "SELECT CAST(floor(site_id / 3) AS BIGINT) AS locus_id, CAST(site_id % 3 + 1 AS INT) AS a_index, alt FROM v_sites",
}
#: Views that a view reads.
NEEDS = {"v_multi": ["v_sites"]}


class Views:
    """The base tables and the views as DataFrames; a view is planned when it is asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in BASE:
            return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        view = f"v_{name}"
        if view not in VIEWS:
            raise AttributeError(name)
        for base in BASE:
            if f" {base}" in VIEWS[view]:
                getattr(self, base).createOrReplaceTempView(base)
        for other in NEEDS.get(view, []):
            getattr(self, other[2:]).createOrReplaceTempView(other)
        return self.spark.sql(VIEWS[view])

    def dealt(self, name: str, base: str, key: str) -> DataFrame:
        """A view whose base table is dealt to tasks by one of the keys that it groups by, so that groups of that key alone need
        no further exchange."""
        getattr(self, base).repartition(key).createOrReplaceTempView(base)
        return self.spark.sql(VIEWS[f"v_{name}"])


def with_views(*names: str) -> str:
    """WITH a AS (...), ... for an oracle query; more CTEs may follow after a comma."""
    wanted = []
    for n in names:
        wanted += [x for x in (*NEEDS.get(n, []), n) if x not in wanted]
    return "WITH " + ", ".join(f"{n} AS ({VIEWS[n]})" for n in wanted)
