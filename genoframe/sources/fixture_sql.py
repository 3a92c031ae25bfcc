"""Synthetic genomics views over the driver's TPC-H-shaped tables.

The SQL below is the test-input definition from FIXTURES.md: the same text is
run by Spark (as DataFrames over the parquet tables) and inlined as ``WITH``
clauses into the DuckDB oracle queries, so both engines see identical inputs.
These views are input generators, not operators: the only cross joins in the
package live here, against the 25-row ``nation`` dimension.
"""

from __future__ import annotations

# Fixture definitions, verbatim from FIXTURES.md.
FIXTURE_SQL: dict[str, str] = {
    "f_site": """
SELECT p_partkey AS site_id, p_partkey % 6 AS chrom_idx,
 CASE p_partkey % 6 WHEN 0 THEN 'I' WHEN 1 THEN 'II' WHEN 2 THEN 'III' WHEN 3 THEN 'IV' WHEN 4 THEN 'V' ELSE 'X' END AS chrom,
 CAST(FLOOR(p_partkey / 6) AS BIGINT) * 20000 + 1 + (p_partkey * 7919) % 20000 AS pos,
 substr('ACGT', CAST(1 + p_partkey % 4 AS INT), 1) AS ref,
 CASE WHEN p_size % 10 = 0 THEN concat(substr('ACGT', CAST(1 + (p_partkey + 1) % 4 AS INT), 1), 'T')
      WHEN p_size % 10 = 1 THEN concat(substr('ACGT', CAST(1 + (p_partkey + 1) % 4 AS INT), 1), ',', substr('ACGT', CAST(1 + (p_partkey + 2) % 4 AS INT), 1))
      ELSE substr('ACGT', CAST(1 + (p_partkey + 1 + p_size % 3) % 4 AS INT), 1) END AS alt
FROM part
""",
    "f_geno": """
SELECT c.site_id, c.chrom, c.pos, c.ref, c.alt, c.strain,
 CASE WHEN (c.site_id * 11 + c.k * 7) % 53 = 0 THEN './.'
      WHEN (c.site_id * 5 + c.k * 3) % 97 = 0 THEN '0/1'
      WHEN c.alt LIKE '%,%' AND (c.site_id + c.k * 5) % 9 = 0 THEN '2/2'
      WHEN (c.site_id * (c.founder + 2) * 31 + c.founder * 17) % 7 < 3 THEN '1/1' ELSE '0/0' END AS gt
FROM (SELECT s.*, CAST(n.n_nationkey AS BIGINT) AS k, concat('S', CAST(n.n_nationkey AS STRING)) AS strain,
  (n.n_nationkey * 13 + CAST(FLOOR(s.site_id / 600) AS BIGINT) * (1 + n.n_nationkey % 3)) % 5 AS founder
  FROM f_site s CROSS JOIN nation n) c
""",
    "f_mask": """
SELECT concat('S', CAST(n.n_nationkey AS STRING)) AS strain, b.chrom, b.bin * 1000 AS start_bin, b.bin * 1000 + 1000 AS end_bin,
 CASE WHEN b.in_run = 1 AND b.lowcov = 0 THEN 16 + (b.bin * 3 + b.k) % 20
      WHEN (b.bin * 31 + b.k * 17 + b.chrom_idx * 5) % 41 = 0 THEN 18
      ELSE (b.bin * 7 + b.k * 11) % 15 END AS var_count,
 CAST(CASE WHEN b.in_run = 1 AND b.lowcov = 1 THEN 2 ELSE 20 + (b.bin * 13 + b.k * 7) % 15 END AS DOUBLE) AS coverage
FROM (SELECT s.chrom, s.chrom_idx, s.bin, CAST(m.n_nationkey AS BIGINT) AS k, m.n_nationkey,
   CASE WHEN (CAST(FLOOR(s.bin / 24) AS BIGINT) * 7 + m.n_nationkey * 5 + s.chrom_idx * 3) % 4 = 0
         AND NOT (s.bin % 24 >= 10 AND s.bin % 24 < 10 + m.n_nationkey % 6) THEN 1 ELSE 0 END AS in_run,
   CASE WHEN (m.n_nationkey + s.chrom_idx) % 5 = 0 THEN 1 ELSE 0 END AS lowcov
  FROM (SELECT p_partkey % 6 AS chrom_idx, CASE p_partkey % 6 WHEN 0 THEN 'I' WHEN 1 THEN 'II' WHEN 2 THEN 'III' WHEN 3 THEN 'IV' WHEN 4 THEN 'V' ELSE 'X' END AS chrom, CAST(FLOOR(p_partkey / 6) AS BIGINT) AS bin FROM part) s CROSS JOIN nation m) b JOIN nation n ON n.n_nationkey = b.n_nationkey
""",
    "f_seg": """
SELECT concat('S', CAST(a.k AS STRING)) AS strain1, 1 AS ind1, concat('S', CAST(b.k AS STRING)) AS strain2, 1 AS ind2, a.chrom,
 a.block * 2000000 + 1 + ((a.k * 3 + b.k * 5) % 4) * 100000 AS start_pos, a.block * 2000000 + 2000000 - ((a.k * 7 + b.k) % 3) * 150000 AS stop_pos,
 CAST(3 + (a.k + b.k) % 9 AS DOUBLE) AS lod
FROM (SELECT DISTINCT CAST(FLOOR(p_partkey / 600) AS BIGINT) AS block, p_partkey % 6 AS ci, CASE p_partkey % 6 WHEN 0 THEN 'I' WHEN 1 THEN 'II' WHEN 2 THEN 'III' WHEN 3 THEN 'IV' WHEN 4 THEN 'V' ELSE 'X' END AS chrom, CAST(n_nationkey AS BIGINT) AS k,
   (n_nationkey * 13 + (CAST(FLOOR(p_partkey / 600) AS BIGINT) + p_partkey % 6) * (1 + n_nationkey % 3)) % 5 AS founder FROM part CROSS JOIN nation) a
JOIN (SELECT DISTINCT CAST(FLOOR(p_partkey / 600) AS BIGINT) AS block, p_partkey % 6 AS ci, CAST(n_nationkey AS BIGINT) AS k,
   (n_nationkey * 13 + (CAST(FLOOR(p_partkey / 600) AS BIGINT) + p_partkey % 6) * (1 + n_nationkey % 3)) % 5 AS founder FROM part CROSS JOIN nation) b
 ON a.block = b.block AND a.ci = b.ci AND a.founder = b.founder AND a.k < b.k
""",
    "f_align": """
SELECT concat('S', CAST(l_suppkey % 25 AS STRING)) AS strain,
 CASE l_linenumber % 6 WHEN 0 THEN 'I' WHEN 1 THEN 'II' WHEN 2 THEN 'III' WHEN 3 THEN 'IV' WHEN 4 THEN 'V' ELSE 'X' END AS chrom,
 l_partkey * 150 + (l_orderkey * 37) % 150 AS start_pos, l_partkey * 150 + (l_orderkey * 37) % 150 + 100 + CAST(l_quantity AS BIGINT) AS end_pos FROM lineitem
""",
    "f_sheet": """
SELECT concat('S', CAST(n_nationkey AS STRING)) AS strain, concat('S', CAST(n_nationkey AS STRING), '.bam') AS bam, concat('S', CAST(n_nationkey AS STRING), '.bam.bai') AS bai FROM nation WHERE n_nationkey % 5 <> 4
""",
    "f_rename": """
SELECT concat('S', CAST(n_nationkey AS STRING)) AS ref_strain, concat('ISO', CAST(n_nationkey + 100 AS STRING)) AS isotype FROM nation WHERE n_nationkey % 4 = 1
""",
    "f_chrom": """
SELECT chrom, chrom_idx, MAX(pos) AS chrom_length FROM f_site GROUP BY chrom, chrom_idx
""",
    "f_markers": """
SELECT chrom, pos FROM f_site WHERE site_id % 3 = 0
""",
    "f_annot": """
SELECT chrom, CAST(FLOOR(pos / 100000) AS BIGINT) * 100000 AS start_pos, CAST(FLOOR(pos / 100000) AS BIGINT) * 100000 + 70000 AS end_pos, MIN(site_id) AS cm FROM f_site GROUP BY chrom, CAST(FLOOR(pos / 100000) AS BIGINT)
""",
    "f_eigen": """
SELECT n_nationkey + 1 AS n, CAST((25 - n_nationkey) * (25 - n_nationkey) AS DOUBLE) / 100 AS eigenvalue FROM nation WHERE n_nationkey < 24
""",
    "f_pc": """
SELECT concat('S', CAST(n_nationkey AS STRING)) AS strain, CAST((n_nationkey * 37) % 101 - 50 AS DOUBLE) / 100 AS pc1, CAST((n_nationkey * 53) % 101 - 50 AS DOUBLE) / 100 AS pc2, CAST((n_nationkey * 71) % 101 - 50 AS DOUBLE) / 100 AS pc3, CAST((n_nationkey * 17) % 101 - 50 AS DOUBLE) / 100 AS pc4, CAST((n_nationkey * 29) % 101 - 50 AS DOUBLE) / 100 AS pc5, CAST((n_nationkey * 83) % 101 - 50 AS DOUBLE) / 100 AS pc6 FROM nation
""",
}

