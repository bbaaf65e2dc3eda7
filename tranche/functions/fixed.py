"""Fixed values that must equal the reference behaviour for right results.

FIXED VALUES — enumerations, status sets, lookup tables, patterns and
default thresholds, stated plainly in their natural order.
"""

# Sub-grades, in order A1..G5 (35 values). Their 1..35 rank is the position.
GRADE_LETTERS = ["A", "B", "C", "D", "E", "F", "G"]
SUB_GRADES = [f"{g}{i}" for g in GRADE_LETTERS for i in range(1, 6)]

HOME_OWNERSHIP = ["RENT", "OWN", "MORTGAGE", "OTHER"]

LOAN_PURPOSES = [
    "debt_consolidation", "credit_card", "home_improvement", "major_purchase",
    "medical", "small_business", "car", "vacation", "wedding", "house",
    "moving", "educational", "renewable_energy", "other",
]

LOAN_STATUSES = [
    "Current", "Fully Paid", "Charged Off", "Late (31-120 days)",
    "In Grace Period", "Late (16-30 days)", "Default",
]

VERIFICATION_STATUSES = ["Verified", "Source Verified", "Not Verified"]

APPLICATION_TYPES = ["Individual", "Joint App"]

# Employment length text -> years (enum form: under one year 0.5, 10+ -> 12).
EMP_LENGTH_YEARS = {
    "< 1 year": 0.5, "1 year": 1.0, "2 years": 2.0, "3 years": 3.0,
    "4 years": 4.0, "5 years": 5.0, "6 years": 6.0, "7 years": 7.0,
    "8 years": 8.0, "9 years": 9.0, "10+ years": 12.0,
}

# Status sets that count as default.
ROW_MODEL_DEFAULT_STATUSES = ["Charged Off", "Default", "Late (31-120 days)"]
OUTCOME_DEFAULT_STATUSES = [
    "Charged Off", "Default", "Does not meet the credit policy. Status:Charged Off",
]

# Synthetic-label probability per sub-grade; unknown -> 0.15.
SYNTHETIC_GRADE_PROBABILITY = {
    "A1": 0.005, "A2": 0.008, "A3": 0.012, "A4": 0.015, "A5": 0.020,
    "B1": 0.025, "B2": 0.030, "B3": 0.035, "B4": 0.045, "B5": 0.055,
    "C1": 0.065, "C2": 0.075, "C3": 0.085, "C4": 0.095, "C5": 0.105,
    "D1": 0.120, "D2": 0.135, "D3": 0.150, "D4": 0.170, "D5": 0.190,
    "E1": 0.210, "E2": 0.230, "E3": 0.250, "E4": 0.270, "E5": 0.290,
    "F1": 0.320, "F2": 0.350, "F3": 0.380, "F4": 0.410, "F5": 0.440,
    "G1": 0.470, "G2": 0.500, "G3": 0.530, "G4": 0.560, "G5": 0.600,
}
SYNTHETIC_UNKNOWN_PROBABILITY = 0.15

# Letter risk for the combined risk score; unknown letter -> 0.35.
LETTER_RISK = {"A": 0.1, "B": 0.2, "C": 0.3, "D": 0.4, "E": 0.5, "F": 0.6, "G": 0.7}
LETTER_RISK_UNKNOWN = 0.35

# Listing-time compliance: columns that leak the outcome.
PROHIBITED_PATTERNS = [
    ".*pymnt.*", ".*rec_.*", "chargeoff.*", "settlement.*", "collection.*", "recovery.*",
]
PROHIBITED_FIELDS = [
    "loan_status", "last_pymnt_d", "last_pymnt_amnt", "next_pymnt_d",
    "total_rec_prncp", "total_rec_int", "recoveries", "collection_recovery_fee",
    "out_prncp", "out_prncp_inv",
]

# Text features: keyword patterns on lower-cased job title and loan title.
JOB_TITLE_PATTERNS = {
    "job_manager": "manager|mgr",
    "job_teacher": "teacher|education",
    "job_nurse": "nurse|rn",
    "job_driver": "driver|truck",
    "job_engineer": "engineer|tech",
    "job_sales": "sales|retail",
}
LOAN_TITLE_PATTERNS = {
    "title_debt": "debt|consolidat",
    "title_credit": "credit card",
    "title_home": "home|house",
    "title_car": "car|auto",
    "title_business": "business|startup",
}

# Risk tiers of a default probability.
RISK_TIER_EDGES = [(0.05, "LOW"), (0.15, "MEDIUM"), (0.30, "HIGH")]
RISK_TIER_TOP = "VERY_HIGH"

# Thresholds used by evaluation and gates.
EVAL_THRESHOLDS = [0.10, 0.15, 0.20, 0.25, 0.30]
MODEL_GATE = {"min_auc": 0.65, "warn_auc": 0.70, "max_brier": 0.20, "min_calibration_p": 0.05}
QUALITY_DEFAULTS = {"max_missing_rate": 0.50, "max_duplicate_rate": 0.01,
                    "min_quality_score": 0.80, "max_outlier_rate": 0.05}
PORTFOLIO_DEFAULTS = {
    "budget_per_quarter": 5000.0, "ticket_size": 25.0, "max_default_probability": 0.25,
    "min_expected_return": 0.05, "max_concentration_per_grade": 0.30,
    "min_loan_diversity": 100, "default_recovery_rate": 0.30,
}
