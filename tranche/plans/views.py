"""SQL text of the derived views, for the DuckDB oracle.

These mirror ``tranche.sources.loans`` row for row; every oracle query is
``WITH <views> SELECT ...`` over the pre-registered supplied tables.
"""

LOANS_SQL = """
loans AS (
 SELECT o.o_orderkey AS id, o.o_totalprice AS loan_amnt,
  CASE WHEN o.o_orderkey % 10 = 0 THEN o.o_totalprice * 0.9 ELSE o.o_totalprice END AS funded_amnt,
  CASE WHEN o.o_orderkey % 4 = 0 THEN ' 60 months' ELSE ' 36 months' END AS term_raw,
  CASE WHEN o.o_orderkey % 4 = 0 THEN 60 ELSE 36 END AS term,
  0.05e0 + l.max_disc + l.max_tax AS int_rate,
  o.o_totalprice / CASE WHEN o.o_orderkey % 4 = 0 THEN 60 ELSE 36 END AS installment,
  translate(substr(o.o_orderpriority,1,1),'12345','ABCDE') AS grade,
  concat(translate(substr(o.o_orderpriority,1,1),'12345','ABCDE'), CAST(o.o_orderkey % 5 + 1 AS VARCHAR)) AS sub_grade,
  CASE WHEN c.c_acctbal < 0 THEN NULL ELSE c.c_acctbal * 12 END AS annual_inc,
  CASE c.c_custkey % 3 WHEN 0 THEN 'RENT' WHEN 1 THEN 'OWN' ELSE 'MORTGAGE' END AS home_ownership,
  CASE o.o_orderstatus WHEN 'F' THEN 'Verified' WHEN 'O' THEN 'Source Verified' ELSE 'Not Verified' END AS verification_status,
  CASE o.o_orderkey % 12 WHEN 0 THEN '< 1 year' WHEN 1 THEN '1 year' WHEN 10 THEN '10+ years' WHEN 11 THEN NULL
       ELSE concat(CAST(o.o_orderkey % 12 AS VARCHAR),' years') END AS emp_length,
  lower(c.c_mktsegment) AS purpose, n.n_name AS addr_state,
  CAST(o.o_orderdate AS DATE) AS issue_d,
  CAST(o.o_orderdate AS DATE) - CAST(c.c_custkey % 6000 AS INTEGER) AS earliest_cr_line,
  CAST(o.o_orderkey % 41 AS DOUBLE) AS dti,
  CAST(COALESCE(l.n_ret,0) AS BIGINT) AS delinq_2yrs,
  CAST(o.o_orderkey % 4 AS INTEGER) AS inq_last_6mths,
  l.n_lines AS open_acc, l.n_lines + c.c_custkey % 20 AS total_acc,
  CAST(o.o_orderkey % 3 AS INTEGER) AS pub_rec,
  l.max_price AS revol_bal, concat(CAST(o.o_orderkey % 101 AS VARCHAR),'%') AS revol_util_raw,
  CASE WHEN COALESCE(l.n_rf,0) >= 2 THEN 'Charged Off' WHEN o.o_orderstatus = 'F' THEN 'Fully Paid' ELSE 'Current' END AS loan_status,
  CASE WHEN COALESCE(l.n_rf,0) >= 2 THEN 1 ELSE 0 END AS is_default,
  (5 * (CAST(substr(o.o_orderpriority,1,1) AS INTEGER) - 1) + o.o_orderkey % 5 + 1) / 40e0 AS pd,
  concat(CAST(year(o.o_orderdate) AS VARCHAR),'Q',CAST(quarter(o.o_orderdate) AS VARCHAR)) AS data_quarter
 FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
 LEFT JOIN (SELECT l_orderkey, MAX(l_discount) max_disc, MAX(l_tax) max_tax, COUNT(*) n_lines,
   MAX(l_extendedprice) max_price,
   CAST(SUM(CASE WHEN l_returnflag='R' THEN 1 ELSE 0 END) AS BIGINT) n_ret,
   CAST(SUM(CASE WHEN l_returnflag='R' AND l_linestatus='F' THEN 1 ELSE 0 END) AS BIGINT) n_rf
   FROM lineitem GROUP BY l_orderkey) l ON l.l_orderkey = o.o_orderkey
)"""

OUTCOMES_SQL = """
outcomes AS (
 SELECT l_orderkey AS id, CAST(l_linenumber AS INTEGER) AS obs_seq,
  CASE WHEN l_returnflag='R' AND l_linestatus='F' THEN 'Charged Off' WHEN l_returnflag='R' THEN 'Late (31-120 days)'
       WHEN l_linestatus='F' THEN 'Fully Paid' ELSE 'Current' END AS loan_status,
  CAST(l_shipdate AS DATE) AS outcome_date,
  concat(CAST(year(l_shipdate) AS VARCHAR),'Q',CAST(quarter(l_shipdate) AS VARCHAR)) AS outcome_quarter
 FROM lineitem
)"""

PAYMENTS_SQL = """
wide AS (
 SELECT loans.*, p.total_pymnt, p.last_pymnt_d, p.recoveries, p.collection_recovery_fee,
  loans.pub_rec AS pub_rec_bankruptcies,
  CASE WHEN loans.loan_status = 'Fully Paid' THEN 0e0 ELSE loans.loan_amnt END AS out_prncp
 FROM loans LEFT JOIN (
  SELECT l_orderkey AS id, SUM(l_extendedprice * (1 - l_discount)) AS total_pymnt,
   MAX(CAST(l_shipdate AS DATE)) AS last_pymnt_d,
   SUM(CASE WHEN l_returnflag = 'R' THEN l_extendedprice * 0.1e0 ELSE 0e0 END) AS recoveries,
   SUM(CASE WHEN l_returnflag = 'R' THEN l_extendedprice * 0.01e0 ELSE 0e0 END) AS collection_recovery_fee
  FROM lineitem GROUP BY l_orderkey) p ON loans.id = p.id
)"""

_EMP_STRIP = "trim(regexp_replace(regexp_replace(emp_length, 'years?', '', 'g'), '[<>]', '', 'g'))"
EMP_YEARS_SQL = (f"CASE WHEN regexp_matches(trim(emp_length), '^<\\s*1\\s*(years?)?$') THEN 0.5e0 "
                 f"ELSE TRY_CAST(CASE WHEN {_EMP_STRIP} = '10+' THEN '10' ELSE {_EMP_STRIP} END AS DOUBLE) END")

LABELLED_SQL = """
labelled AS (
 SELECT loans.*, TRY_CAST(rtrim(revol_util_raw, '%') AS DOUBLE) / 100 AS revol_util,
  {emp} AS emp_length_years, COALESCE(lo.flag, 0) AS label,
  CASE WHEN data_quarter < '2000Q1' THEN 'train' WHEN data_quarter < '2001Q1' THEN 'validation' ELSE 'backtest' END AS split
 FROM loans LEFT JOIN (
  SELECT id, CASE WHEN loan_status IN ('Charged Off','Default','Does not meet the credit policy. Status:Charged Off')
   THEN 1 ELSE 0 END AS flag FROM (
   SELECT *, row_number() OVER (PARTITION BY id ORDER BY outcome_date DESC, obs_seq DESC) AS rn FROM outcomes)
  WHERE rn = 1) lo ON loans.id = lo.id
)"""

SPLIT_CASE = """CASE WHEN data_quarter < '2000Q1' THEN 'train'
  WHEN data_quarter < '2001Q1' THEN 'validation' ELSE 'backtest' END"""
LABELLED_SQL = LABELLED_SQL.replace("{emp}", EMP_YEARS_SQL)


def with_views(body: str, *ctes: str) -> str:
    """``WITH cte1, cte2, ... body``; ctes default to the loan view."""
    ctes = ctes or (LOANS_SQL,)
    ctes = tuple(c for c in ctes if c and c.strip())
    if not ctes:
        return body.strip()
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n" + body.strip()
