"""Rules, thresholds and word lists as data.

Everything below marked FIXED VALUES must equal the source application's
values for results to agree; it is stated plainly and in natural order.
Thresholds are dataclasses so the same operators run on survey column names
and on stand-in tables.
"""

from __future__ import annotations

from dataclasses import dataclass

# ---------------------------------------------------------------- FIXED VALUES
# Identifier and target names.
ID_COL = "SEQN"
TARGET_COL = "LIVER_HIGH_RISK_PROFILE"

# Feature sets used for training (clinical 6, general 12; combined = both).
CLINICAL_FEATURES = ["LBXPLTSI", "LBXGLU", "LBXGH", "LBDHDD", "LBXTC", "LBXTLG"]
GENERAL_FEATURES = [
    "RIDAGEYR", "RIAGENDR", "RIDRETH3", "DMDEDUC2", "BMXBMI", "BMXWAIST",
    "SMQ020", "SMQ040", "ALQ130", "DIQ010", "BPQ020", "MCQ160E",
]
# Feature list the serving side asks for (differs from training; P4 reconciles).
SERVING_CLINICAL_FEATURES = ["LBXALT", "LBXAST", "LBXPLTSI", "LBXGLU", "LBXGH",
                             "LBDHDD", "LBXTCA", "LBXTR"]

# Survey modules joined onto the spine, in join order, with their columns.
MODULE_COLUMNS = {
    "BMX": ["BMXBMI", "BMXWAIST"],
    "SMQ": ["SMQ020", "SMQ040"],
    "ALQ": ["ALQ130"],
    "DIQ": ["DIQ010"],
    "BPQ": ["BPQ020"],
    "MCQ": ["MCQ160E"],
    "CBC": ["LBXPLTSI"],
    "GLU": ["LBXGLU"],
    "GHB": ["LBXGH"],
    "HDL": ["LBDHDD"],
    "TCHOL": ["LBXTC"],
    "TRIGLY": ["LBXTLG"],
}
SPINE_COLUMNS = ["RIDAGEYR", "RIAGENDR", "RIDRETH3", "DMDEDUC2"]
# Labs named by the "at least one critical lab" guard.
CRITICAL_LABS = ["CBC", "GLU", "GHB"]

# Columns the label rule requires to be present (all nine non-null).
LABEL_REQUIRED = ["BMXBMI", "LBXGLU", "LBXGH", "DIQ010", "LBDHDD", "LBXTLG",
                  "SMQ020", "ALQ130", "LBXPLTSI"]


@dataclass(frozen=True)
class LabelThresholds:
    """Label rule: (metabolic AND (lipid OR other)) OR low platelets."""
    high_bmi: float = 30
    high_glucose: float = 140
    high_hba1c: float = 6.5
    is_diabetic: int = 1
    male: int = 1
    female: int = 2
    low_hdl_male: float = 40
    low_hdl_female: float = 50
    high_trigs: float = 150
    is_smoker: int = 1
    heavy_alcohol: int = 1
    low_platelets: float = 150
    bmi: str = "BMXBMI"
    glucose: str = "LBXGLU"
    hba1c: str = "LBXGH"
    diabetes: str = "DIQ010"
    sex: str = "RIAGENDR"
    hdl: str = "LBDHDD"
    trigs: str = "LBXTLG"
    smoker: str = "SMQ020"
    alcohol: str = "ALQ130"
    platelets: str = "LBXPLTSI"
    required: tuple = tuple(LABEL_REQUIRED)


# Risk band cut points on the rounded probability (strictly greater than).
RISK_HIGH = 0.66
RISK_MEDIUM = 0.33
PROB_DECIMALS = 4

# Readable result text by prediction.
RESULT_POSITIVE = "Liver Disease Risk Detected"
RESULT_NEGATIVE = "No Liver Disease Risk Detected"

# Condition ladder: ordered, first match wins. (rule number, condition text)
CONDITIONS = [
    (1, "Acute Liver Injury (Very High ALT/AST)"),
    (2, "Likely Metabolic Dysfunction-Associated Steatohepatitis (MASH)/NAFLD"),
    (3, "Likely Alcoholic Liver Disease"),
    (4, "Possible Chronic Liver Disease/Cirrhosis (Low Platelets + Risk Factors)"),
    (5, "Possible Gilbert's Syndrome (Benign Bilirubin Elevation)"),
    (6, "High Risk for Liver Disease (Metabolic Factors)"),
    (7, "Low Risk Profile for Liver Disease"),
    (8, "Generalized Liver Risk"),
]

# Suggestions per condition, in the order shown.
SUGGESTIONS = {
    "Acute Liver Injury (Very High ALT/AST)": [
        "Seek immediate medical attention. Very high ALT/AST levels require urgent evaluation.",
        "List all medications, supplements, and potential toxin exposures for your doctor.",
        "Tests for viral hepatitis (HAV, HBV, HCV) might be needed.",
    ],
    "Likely Metabolic Dysfunction-Associated Steatohepatitis (MASH)/NAFLD": [
        "Consult a gastroenterologist or hepatologist for further evaluation (e.g., FibroScan, MRI-PDFF).",
        "Focus on weight loss through diet and exercise (even 5-10% can help).",
        "Aggressively manage blood sugar, cholesterol, and triglycerides.",
        "Avoid alcohol completely.",
    ],
    "Likely Alcoholic Liver Disease": [
        "Complete abstinence from alcohol is crucial.",
        "Consult a liver specialist for assessment and support.",
        "Address nutritional deficiencies common in alcohol use disorder.",
    ],
    "Possible Chronic Liver Disease/Cirrhosis (Low Platelets + Risk Factors)": [
        "Urgent consultation with a hepatologist is recommended.",
        "Evaluation for portal hypertension and varices might be needed.",
        "Further imaging (Ultrasound, CT, MRI) and fibrosis scores (APRI, FIB-4) are indicated.",
    ],
    "Possible Gilbert's Syndrome (Benign Bilirubin Elevation)": [
        "Often benign, but confirm with a doctor.",
        "Usually doesn't require specific treatment, but monitor bilirubin levels.",
        "Inform other healthcare providers about this condition.",
    ],
    "High Risk for Liver Disease (Metabolic Factors)": [
        "Significant metabolic risk factors present.",
        "Focus on lifestyle changes: weight loss, healthy diet, regular exercise.",
        "Monitor liver enzymes regularly.",
        "Consult your doctor about managing diabetes and obesity.",
    ],
    "Low Risk Profile for Liver Disease": [
        "Maintain your current healthy habits.",
        "Continue regular checkups.",
        "Avoid excessive alcohol and unnecessary medications.",
    ],
    "Generalized Liver Risk": [
        "Multiple factors contribute to liver health.",
        "Consider discussing your results with a healthcare provider.",
        "Focus on a balanced diet, regular exercise, and limiting alcohol.",
        "Review medications with your doctor for potential liver impact.",
    ],
}

# Text answers counted as "yes" by the ladder.
ALCOHOL_YES = ["1", "yes", "true", "y"]
HISTORY_YES = ["1", "yes"]

# Ladder argument -> survey column, with the default used when the column is
# absent from the scored table (None = no default, stays missing).
LADDER_INPUTS = [
    ("age", "RIDAGEYR", None),
    ("bmi", "BMXBMI", None),
    ("alt", "LBXALT", 0.0),
    ("ast", "LBXAST", 0.0),
    ("platelets", "LBXPLTSI", 150.0),
    ("ggt", "LBXGGT", 0.0),
    ("bilirubin", "LBXBILI", 0.0),
    ("glucose", "LBXGLU", 0.0),
    ("hba1c", "LBXGH", 0.0),
    ("systolic_bp", "BPXSY1", 0.0),
    ("diastolic_bp", "BPXDI1", 0.0),
    ("hdl", "LBDHDD", 0.0),
    ("total_chol", "LBXTCA", 0.0),
    ("triglycerides", "LBXTR", 0.0),
    ("diabetes", "DIQ010", None),
    ("hypertension", "BPQ020", None),
    ("smoking", "SMQ020", None),
    ("alcohol", "ALQ130", None),
    ("family_history", "MCQ160E", None),
]

# Model-type alias map; unknown names fall back to the default.
MODEL_ALIASES = {
    "liver_clinical": "clinical",
    "clinical": "clinical",
    "liver_general": "lifestyle",
    "lifestyle": "lifestyle",
    "general": "lifestyle",
}
MODEL_ALIAS_DEFAULT = "clinical"

# Record-type buckets (nested substring tests on the lower-cased type).
BUCKET_LIVER = "liver"
BUCKET_CLINICAL = "clinical"
BUCKET_LIFESTYLE = "lifestyle"
BUCKET_NAMES = {"clinical": "Liver Clinical", "lifestyle": "Liver Lifestyle",
                "liver_other": "Liver Other", "other": "Other"}

# Coded survey answers: (field, code, label).
YES_NO_CODES = [(1, "Yes"), (2, "No"), (7, "Refused"), (9, "Don't know")]
DIABETES_CODES = [(1, "Yes"), (2, "No"), (3, "Borderline"), (7, "Refused"), (9, "Don't know")]
SEX_CODES = [(1, "Male"), (2, "Female")]
ETHNICITY_CODES = [(1, "Mexican American"), (2, "Other Hispanic"), (3, "Non-Hispanic White"),
                   (4, "Non-Hispanic Black"), (5, "Other Race")]
EDUCATION_CODES = [(1, "Less than 9th grade"), (2, "9-11th grade"), (3, "High school graduate"),
                   (4, "Some college"), (5, "College graduate"), (7, "Refused"), (9, "Don't know")]
CODED_FIELDS = {
    "RIAGENDR": SEX_CODES,
    "RIDRETH3": ETHNICITY_CODES,
    "DMDEDUC2": EDUCATION_CODES,
    "SMQ020": YES_NO_CODES,
    "SMQ040": YES_NO_CODES,
    "ALQ130": YES_NO_CODES,
    "DIQ010": DIABETES_CODES,
    "BPQ020": YES_NO_CODES,
    "MCQ160E": YES_NO_CODES,
}

# Access policy.
COOLDOWN_DAYS = 30
CHAT_HISTORY_LIMIT = 10      # last messages handed to the chat
MONTHLY_FREE_SCORINGS = 1
RATE_LIMIT_DEFAULT = 10      # per minute
RATE_LIMIT_CHAT = 5          # per minute
JOIN_WINDOW_MINUTES = 30
TRAILING_DAYS = 180          # 6 x 30 days
PAID_ONLY_ENDPOINTS = ["chat", "book_appointment"]
SCORING_ENDPOINT = "predict"

# Lookup defaults.
UNKNOWN = "Unknown"
NOT_AVAILABLE = "N/A"
DEFAULT_ROLE = "user"

# Model family names (metrics table).
MODEL_NAMES = ["Logistic Regression", "Random Forest", "Boosted Trees", "Linear SVM"]
SEED = 42
TEST_FRACTION = 0.2
CV_FOLDS = 5
# ------------------------------------------------------------ end FIXED VALUES
