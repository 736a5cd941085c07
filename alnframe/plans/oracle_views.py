"""DuckDB text of the adapter views, used as CTEs by the oracle queries.

These are written independently of the Spark code (they are the check), in DuckDB's
dialect, over the pre-registered driver views.
"""

READS = r"""
reads AS (
  SELECT concat('r', CAST(l_orderkey AS VARCHAR)) AS read_name,
    CAST(3 + CASE WHEN l_linenumber%2=1 THEN 64 ELSE 128 END + CASE WHEN l_returnflag='R' THEN 16 ELSE 0 END
      + CASE WHEN l_linestatus='O' THEN 32 ELSE 0 END + CASE WHEN l_partkey%17=0 THEN 4 ELSE 0 END
      + CASE WHEN l_partkey%23=0 THEN 256 ELSE 0 END AS INTEGER) AS flag,
    CAST(l_suppkey%25 AS INTEGER) AS ref_index,
    CAST(1+(l_partkey*7919+l_orderkey*31)%1000000 AS INTEGER) AS pos,
    CAST(l_quantity AS INTEGER) AS mapq,
    CASE l_linenumber%7 WHEN 0 THEN '5S95M' WHEN 1 THEN '100M' WHEN 2 THEN '50M2I48M' WHEN 3 THEN '40M3D60M'
      WHEN 4 THEN '3H10S80M10S' WHEN 5 THEN '30M200N70M' ELSE '20M1I20M2D59M' END AS cigar,
    translate(substr(concat(md5(concat(k,'a')),md5(concat(k,'b')),md5(concat(k,'c')),md5(concat(k,'d'))),1,100),
      '0123456789abcdef','ACGTACGTACGTACGN') AS seq,
    translate(substr(concat(md5(concat(k,'e')),md5(concat(k,'f')),md5(concat(k,'g')),md5(concat(k,'h'))),1,100),
      '0123456789abcdef','#%&(+-/13579;=?A') AS qual,
    k AS read_id
  FROM (SELECT *, concat(CAST(l_orderkey AS VARCHAR),'|',CAST(l_linenumber AS VARCHAR),'|',
          CAST(l_partkey AS VARCHAR),'|',CAST(l_suppkey AS VARCHAR)) AS k FROM lineitem) x
)"""

# Contig name of an index in the adapter dictionary.
CONTIG = ("CASE WHEN {r}=0 THEN 'chrM' WHEN {r} BETWEEN 1 AND 22 THEN 'chr'||CAST({r} AS VARCHAR) "
          "WHEN {r}=23 THEN 'chrX' WHEN {r}=24 THEN 'chrY' ELSE '*' END")

# Reads with a few derived columns computed from the CIGAR text by regular expressions.
READS_X = r"""
reads_x AS (
  SELECT *,
    """ + CONTIG.format(r="ref_index") + r""" AS ref_name,
    CAST(coalesce(list_sum(list_transform(regexp_extract_all(cigar, '(\d+)[MDN=X]', 1), lambda x: CAST(x AS INTEGER))), 0) AS INTEGER) AS ref_len,
    CAST(coalesce(list_sum(list_transform(regexp_extract_all(cigar, '(\d+)[MIS=X]', 1), lambda x: CAST(x AS INTEGER))), 0) AS INTEGER) AS read_len
  FROM reads
),
reads_e AS (
  SELECT *, CASE WHEN flag & 4 <> 0 THEN 0 ELSE pos + ref_len - 1 END AS align_end FROM reads_x
)"""

TARGETS = r"""
targets AS (
  SELECT CAST(o_custkey%25 AS INTEGER) AS ref_index, CAST(1+(o_orderkey*104729)%1000000 AS INTEGER) AS s,
    CAST(500+(o_orderkey*104729)%1000000 AS INTEGER) AS e, o_orderkey AS target_id FROM orders
)"""

PAIRS = r"""
pairs AS (
  SELECT concat('p', CAST(o_orderkey AS VARCHAR)) AS read_name, 99 AS flag, CAST(o_custkey%25 AS INTEGER) AS ref_index,
    CAST(1+(o_orderkey*104729)%900000 AS INTEGER) AS pos, CAST(o_custkey%25 AS INTEGER) AS mate_ref_index,
    CAST(151+(o_orderkey*104729)%900000+o_custkey%200 AS INTEGER) AS mate_pos FROM orders
  UNION ALL
  SELECT concat('p', CAST(o_orderkey AS VARCHAR)), 147, CAST(o_custkey%25 AS INTEGER),
    CAST(151+(o_orderkey*104729)%900000+o_custkey%200 AS INTEGER), CAST(o_custkey%25 AS INTEGER),
    CAST(1+(o_orderkey*104729)%900000 AS INTEGER)
  FROM orders WHERE o_orderkey%11<>0
)"""

KNOWN_SITES = r"""
known_sites AS (
  SELECT DISTINCT CAST(p_size%25 AS INTEGER) AS ref_index, CAST(1+(p_partkey*7919)%1000000 AS INTEGER) AS pos FROM part
)"""

SEQUENCES = r"""
sequences AS (
  SELECT CAST(i AS INTEGER) AS seq_index, """ + CONTIG.format(r="i") + r""" AS name, 1000000 AS length
  FROM range(0, 25) t(i)
)"""

# Reference base at (ref_index, pos): 32-base chunks of translated md5 text.
REF_BASE = ("substr(translate(md5(concat(CAST({r} AS VARCHAR),'|',CAST(({p}-1)//32 AS VARCHAR))),"
            "'0123456789abcdef','ACGTACGTACGTACGN'), CAST(({p}-1)%32 AS INTEGER)+1, 1)")


def with_views(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"
