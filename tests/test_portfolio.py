"""Portfolio selection: fixture cases and plain-loop property checks."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tranche.operators import portfolio as pf

SCHEMA = "data_quarter string, id long, loan_amnt double, funded_amnt double, int_rate double, sub_grade string, term int, pd double"


def loans(spark, rows, q="2016Q1"):
    return spark.createDataFrame([(q, *r) for r in rows], SCHEMA)


def select(spark, rows, strategy="lowest_risk", **kw):
    pol = pf.PortfolioPolicy(strategy=strategy, **kw)
    return pf.select_investments(loans(spark, rows), policy=pol)


def ids(df):
    return sorted(r["loan_id"] for r in df.collect())


def test_budget_case(spark):
    rates = [.10, .12, .15, .18, .20]
    pds = [.05, .06, .07, .08, .09]
    rows = [(i + 1, 25.0, 25.0, r, "B1", 36, p) for i, (r, p) in enumerate(zip(rates, pds))]
    s = select(spark, rows, budget=50)
    assert ids(s) == [1, 2]
    assert float(s.agg(F.sum("investment_amount")).first()[0]) <= 50


def test_lowest_risk_only_passing(spark):
    rows = [(1, 25.0, 25.0, .15, "A1", 36, .15), (2, 25.0, 25.0, .10, "A1", 36, .05), (3, 25.0, 25.0, .20, "A1", 36, .25)]
    assert ids(select(spark, rows, budget=100)) == [2]


def test_highest_value(spark):
    rows = [(1, 25.0, 25.0, .20, "A1", 36, .10), (2, 25.0, 25.0, .10, "A1", 36, .10), (3, 25.0, 25.0, .15, "A1", 36, .10)]
    assert 1 in ids(select(spark, rows, "highest_expected_value", budget=50))
    assert 2 not in ids(select(spark, rows, "highest_expected_value", budget=50))


def test_risk_filter(spark):
    rows = [(i + 1, 25.0, 25.0, r, "A1", 36, p) for i, (r, p) in enumerate(zip([.10, .15, .20, .25], [.08, .15, .30, .40]))]
    got = ids(select(spark, rows, budget=1000, max_default_probability=.25, min_expected_return=.01))
    assert got == [1, 2]


def test_return_formula(spark):
    c = pf.candidates(loans(spark, [(1, 25.0, 25.0, .10, "A1", 36, .05), (2, 25.0, 25.0, .20, "A1", 36, .15)]))
    got = {r["loan_id"]: r["expected_return"] for r in c.collect()}
    assert got[1] == pytest.approx(.95 * .10 - .05 * .7)
    assert got[2] == pytest.approx(.85 * .20 - .15 * .7)


def test_metrics_case(spark):
    rows = [(1, 25.0, 25.0, .10, "A1", 36, .05), (2, 25.0, 25.0, .15, "B1", 36, .10), (3, 25.0, 25.0, .20, "C1", 36, .15)]
    s = select(spark, rows, budget=75)
    m = pf.portfolio_metrics(s).first()
    assert m["total_investment"] == pytest.approx(75)
    assert m["loan_count"] == 3
    shares = {r["risk_grade"]: r["share"] for r in pf.share_by(s, "risk_grade").collect()}
    assert all(v == pytest.approx(1 / 3) for v in shares.values())


def test_balanced_case(spark):
    rows = [(1, 25.0, 25.0, .25, "A1", 36, .20), (2, 25.0, 25.0, .10, "B2", 36, .05), (3, 25.0, 25.0, .15, "C3", 36, .10)]
    s = select(spark, rows, "balanced_portfolio", budget=75)
    amounts = sorted(float(r["investment_amount"]) for r in s.collect())
    assert amounts == [22.5, 22.5, 22.5]  # the 30 % grade cap of 75 shrinks each ticket


def test_balanced_single_grade(spark):
    rows = [(1, 25.0, 25.0, .25, "A1", 36, .20), (2, 25.0, 25.0, .10, "A1", 36, .05), (3, 25.0, 25.0, .15, "A1", 36, .10)]
    s = select(spark, rows, "balanced_portfolio", budget=75)
    assert sorted(float(r["investment_amount"]) for r in s.collect()) == [22.5]


def test_empty_case(spark):
    rows = [(1, 25.0, 25.0, .05, "A1", 36, .30), (2, 25.0, 25.0, .08, "A1", 36, .35)]
    s = select(spark, rows, budget=50, max_default_probability=.10)
    assert s.count() == 0
    m = pf.portfolio_metrics(s, groups=loans(spark, rows)).first()
    assert m["loan_count"] == 0 and m["total_investment"] == 0


def test_small_budget(spark):
    s = select(spark, [(1, 100.0, 100.0, .15, "A1", 36, .10)], budget=50)
    assert float(s.first()["investment_amount"]) == 25.0


# ---------------------------------------------------------------- loops
def loop_budgeted(cands, budget):
    chosen, total = {}, Decimal(0)
    for c in cands:
        if total + c["ticket"] <= budget:
            chosen[c["id"]] = c["ticket"]
            total += c["ticket"]
        else:
            if budget - total > 1:
                chosen[c["id"]] = budget - total
            break
    return chosen


def loop_balanced(cands, budget, conc):
    cap = budget * conc
    chosen, total, per = {}, Decimal(0), {}
    for c in cands:
        amt = min(c["ticket"], cap - per.get(c["grade"], Decimal(0)))
        if amt > 1 and total + amt <= budget:
            chosen[c["id"]] = amt
            total += amt
            per[c["grade"]] = per.get(c["grade"], Decimal(0)) + amt
    return chosen


def loop_policy(cands, budget):
    rest, chosen = budget, []
    for c in cands:
        if c["amount"] <= rest:
            chosen.append(c["id"])
            rest -= c["amount"]
    return chosen


def _random_groups(seed, groups=30):
    rnd = random.Random(seed)
    rows = []
    for g in range(groups):
        for i in range(rnd.randint(1, 40)):
            amt = rnd.choice([rnd.uniform(1.5, 60), 25.0, rnd.uniform(0.5, 3)])
            rows.append((f"G{g:02d}", g * 1000 + i, round(amt, 2), round(amt, 2), round(rnd.uniform(.05, .3), 3),
                         rnd.choice(["A1", "A2", "B1", "C3"]), 36, round(rnd.choice([.02, .05, .1, .15]), 3)))
    return rows


def _spark_frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("seed", [1, 2])
def test_lowest_risk_matches_loop(spark, seed):
    rows = _random_groups(seed)
    budget = Decimal(200)
    pol = pf.PortfolioPolicy(budget=200, min_expected_return=-10, max_default_probability=1.0, salt_buckets=4)
    got = pf.select_lowest_risk(pf.candidates(_spark_frame(spark, rows), policy=pol), pol).collect()
    got_by = {}
    for r in got:
        got_by.setdefault(r["data_quarter"], {})[r["loan_id"]] = r["investment_amount"]
    for g in sorted({r[0] for r in rows}):
        cs = sorted([{"id": r[1], "p": r[7], "ticket": Decimal(str(min(r[3], 25.0))).quantize(Decimal("0.0001"))}
                     for r in rows if r[0] == g], key=lambda c: (c["p"], c["id"]))
        assert got_by.get(g, {}) == loop_budgeted(cs, budget), g


@pytest.mark.parametrize("seed", [3])
def test_balanced_matches_loop(spark, seed):
    rows = _random_groups(seed, groups=20)
    pol = pf.PortfolioPolicy(budget=120, min_expected_return=-10, max_default_probability=1.0,
                             max_concentration_per_grade=0.3)
    c = pf.candidates(_spark_frame(spark, rows), policy=pol)
    got = pf.select_balanced(c, pol).collect()
    exp_rows = {r["loan_id"]: r for r in c.collect()}
    got_by = {}
    for r in got:
        got_by.setdefault(r["data_quarter"], {})[r["loan_id"]] = r["investment_amount"]
    for g in sorted({r[0] for r in rows}):
        cs = [{"id": i, "grade": e["risk_grade"], "ticket": e["ticket"],
               "score": e["expected_return"] / (e["default_probability"] + 0.01)}
              for i, e in exp_rows.items() if e["data_quarter"] == g]
        cs.sort(key=lambda x: (-x["score"], x["id"]))
        assert got_by.get(g, {}) == loop_balanced(cs, Decimal(120), Decimal("0.3")), g


def test_policy_matches_loop(spark):
    rows = _random_groups(5, groups=20)
    df = _spark_frame(spark, rows).withColumnRenamed("data_quarter", "data_quarter")
    preds = df.select(F.col("id").alias("loan_id"), F.col("pd").alias("default_probability"),
                      F.lit(0.0).alias("risk_score"))
    got = pf.policy_select(preds, df, budget=150.0, max_risk_tolerance=0.1).collect()
    got_by = {}
    for r in got:
        got_by.setdefault(r["data_quarter"], set()).add(r["loan_id"])
    for g in sorted({r[0] for r in rows}):
        cs = sorted([{"id": r[1], "p": r[7], "amount": Decimal(str(r[3])).quantize(Decimal("0.0001"))}
                     for r in rows if r[0] == g and r[7] <= 0.1], key=lambda c: (c["p"], c["id"]))
        assert got_by.get(g, set()) == set(loop_policy(cs, Decimal(150))), g


def _big_groups(seed, groups=6, n=250):
    rnd = random.Random(seed)
    rows = []
    for g in range(groups):
        for i in range(n):
            amt = rnd.choice([rnd.uniform(1.5, 60), 25.0, rnd.uniform(0.5, 3)])
            rows.append((f"H{g}", g * 10000 + i, round(amt, 2), round(amt, 2), round(rnd.uniform(.05, .3), 3),
                         rnd.choice(["A1", "A2", "B1"]), 36, round(rnd.choice([.02, .05, .1, .15]), 3)))
    return rows


def test_pruned_paths_match_loops(spark):
    """Few salt buckets and long groups, so the exact pre-pruning removes rows."""
    rows = _big_groups(11)
    df = _spark_frame(spark, rows)
    pol = pf.PortfolioPolicy(budget=300, min_expected_return=-10, max_default_probability=1.0, salt_buckets=2,
                             max_concentration_per_grade=0.3)
    c = pf.candidates(df, policy=pol)
    cand_rows = {r["loan_id"]: r for r in c.collect()}
    low = {}
    for r in pf.select_lowest_risk(c, pol).collect():
        low.setdefault(r["data_quarter"], {})[r["loan_id"]] = r["investment_amount"]
    bal = {}
    for r in pf.select_balanced(c, pol).collect():
        bal.setdefault(r["data_quarter"], {})[r["loan_id"]] = r["investment_amount"]
    preds = df.select(F.col("id").alias("loan_id"), F.col("pd").alias("default_probability"), F.lit(0.0).alias("risk_score"))
    pol_sel = {}
    for r in pf.policy_select(preds, df, budget=300.0, max_risk_tolerance=0.1, salt_buckets=2).collect():
        pol_sel.setdefault(r["data_quarter"], set()).add(r["loan_id"])
    for g in sorted({r[0] for r in rows}):
        cs = [dict(id=i, p=e["default_probability"], ticket=e["ticket"], grade=e["risk_grade"],
                   score=e["expected_return"] / (e["default_probability"] + 0.01))
              for i, e in cand_rows.items() if e["data_quarter"] == g]
        assert low.get(g, {}) == loop_budgeted(sorted(cs, key=lambda x: (x["p"], x["id"])), Decimal(300)), g
        assert bal.get(g, {}) == loop_balanced(sorted(cs, key=lambda x: (-x["score"], x["id"])), Decimal(300),
                                               Decimal("0.3")), g
        pc = sorted([{"id": r[1], "p": r[7], "amount": Decimal(str(r[3])).quantize(Decimal("0.0001"))}
                     for r in rows if r[0] == g and r[7] <= 0.1], key=lambda c: (c["p"], c["id"]))
        assert pol_sel.get(g, set()) == set(loop_policy(pc, Decimal(300))), g


def _alternating(n, budget):
    """1, almost the budget, 1, a little less, ...: a skip after every pick."""
    return [(i, Decimal(1) if i % 2 == 0 else Decimal(budget) - Decimal(i) / 2) for i in range(n)]


@pytest.mark.parametrize("batch", [5000, 16])
def test_policy_takes_every_fitting_loan(spark, batch):
    """More skips than any fixed number of rounds would survive."""
    rows = [("Q", i, float(a), float(a), .1, "A1", 36, .001 * i) for i, a in _alternating(150, 100)]
    df = _spark_frame(spark, rows)
    preds = df.select(F.col("id").alias("loan_id"), F.col("pd").alias("default_probability"), F.lit(0.0).alias("risk_score"))
    got = {r["loan_id"] for r in pf.policy_select(preds, df, budget=100.0, max_risk_tolerance=1.0, batch=batch).collect()}
    assert got == set(loop_policy([{"id": i, "amount": a} for i, a in _alternating(150, 100)], Decimal(100)))


def test_balanced_with_large_tickets(spark):
    rnd = random.Random(12)
    rows = [("Q", i, a := round(rnd.choice([1.5, 2.0, rnd.uniform(30, 400)]), 2), a, .1, rnd.choice(["A1", "B1", "C1"]), 36, round(.001 * i, 4)) for i in range(240)]
    pol = pf.PortfolioPolicy(budget=300, ticket_size=500, min_expected_return=-10, max_default_probability=1.0, max_concentration_per_grade=0.5)
    c = pf.candidates(_spark_frame(spark, rows), policy=pol)
    cs = [{"id": r["loan_id"], "grade": r["risk_grade"], "ticket": r["ticket"], "score": r["expected_return"] / (r["default_probability"] + 0.01)} for r in c.collect()]
    want = loop_balanced(sorted(cs, key=lambda x: (-x["score"], x["id"])), Decimal(300), Decimal("0.5"))
    for batch in (5000, 24):
        assert {r["loan_id"]: r["investment_amount"] for r in pf.select_balanced(c, pol, batch=batch).collect()} == want


def test_text_rates(spark):
    rows = [("Q", 1, 25.0, 25.0, "12.5%", "A1", 36, .05), ("Q", 2, 25.0, 25.0, "0.2", "A1", 36, .15), ("Q", 3, 25.0, 25.0, "x", "A1", 36, .15)]
    df = spark.createDataFrame(rows, SCHEMA.replace("int_rate double", "int_rate string"))
    got = {r["loan_id"]: r["interest_rate"] for r in pf.candidates(df).collect()}
    assert got == {1: pytest.approx(.125), 2: pytest.approx(.2), 3: 0.0}


def test_budget_cut_sits_below_the_first_row_shuffle(spark):
    """The rows' only exchanges come after the filter on the last bucket, and
    few rows pass it."""
    rows = [("Q", i, 25.0, 25.0, .2, "A1", 36, .0001 * i) for i in range(5000)] + [("R", 9000, 25.0, 25.0, .2, "A1", 36, None)]
    pol = pf.PortfolioPolicy(budget=100, min_expected_return=-10, max_default_probability=1.0)
    c = pf.candidates(_spark_frame(spark, rows), policy=pol)
    bucket = pf._bucket(F.col("default_probability"), True)
    assert pf.cut_by_score(c, bucket, pol).count() < 100
    plan = pf.select_lowest_risk(c, pol)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    join = next(i for i, line in enumerate(plan) if "Join Inner" in line)
    assert sum("Window [" in line for line in plan[:join]) == 2     # both windows over rows stand above the filtering join
    got = {r["loan_id"] for r in pf.select_lowest_risk(c, pol).collect()}
    assert got == {0, 1, 2, 3, 9000}
