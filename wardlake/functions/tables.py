"""Lookup tables. Fixed values throughout: results must equal those that sites already have."""

GENDER = {"m": "male", "male": "male", "f": "female", "female": "female", "o": "other", "other": "other", "u": "unknown", "unknown": "unknown", "non-binary": "other", "nb": "other"}
MARITAL = {
    "S": "single", "SINGLE": "single", "M": "married", "MARRIED": "married", "D": "divorced", "DIVORCED": "divorced", "W": "widowed", "WIDOWED": "widowed",
    "P": "partner", "DOMESTIC PARTNER": "partner", "U": "unknown", "UNKNOWN": "unknown",
}
STATES = {
    "ALABAMA": "AL", "ALASKA": "AK", "ARIZONA": "AZ", "ARKANSAS": "AR", "CALIFORNIA": "CA", "COLORADO": "CO", "CONNECTICUT": "CT", "DELAWARE": "DE", "FLORIDA": "FL",
    "GEORGIA": "GA", "HAWAII": "HI", "IDAHO": "ID", "ILLINOIS": "IL", "INDIANA": "IN", "IOWA": "IA", "KANSAS": "KS", "KENTUCKY": "KY", "LOUISIANA": "LA", "MAINE": "ME",
    "MARYLAND": "MD", "MASSACHUSETTS": "MA", "MICHIGAN": "MI", "MINNESOTA": "MN", "MISSISSIPPI": "MS", "MISSOURI": "MO", "MONTANA": "MT", "NEBRASKA": "NE", "NEVADA": "NV",
    "NEW HAMPSHIRE": "NH", "NEW JERSEY": "NJ", "NEW MEXICO": "NM", "NEW YORK": "NY", "NORTH CAROLINA": "NC", "NORTH DAKOTA": "ND", "OHIO": "OH", "OKLAHOMA": "OK",
    "OREGON": "OR", "PENNSYLVANIA": "PA", "RHODE ISLAND": "RI", "SOUTH CAROLINA": "SC", "SOUTH DAKOTA": "SD", "TENNESSEE": "TN", "TEXAS": "TX", "UTAH": "UT",
    "VERMONT": "VT", "VIRGINIA": "VA", "WASHINGTON": "WA", "WEST VIRGINIA": "WV", "WISCONSIN": "WI", "WYOMING": "WY", "DISTRICT OF COLUMBIA": "DC",
}
ENCOUNTER_TYPE = {
    "i": "inpatient", "inpatient": "inpatient", "ip": "inpatient", "o": "outpatient", "outpatient": "outpatient", "op": "outpatient", "e": "emergency",
    "emergency": "emergency", "ed": "emergency", "er": "emergency", "observation": "observation", "obs": "observation", "ambulatory": "ambulatory", "amb": "ambulatory",
    "telehealth": "telehealth", "virtual": "telehealth", "recurring": "recurring", "series": "recurring",
}
ENCOUNTER_STATUS = {
    "planned": "planned", "scheduled": "planned", "arrived": "arrived", "checked-in": "arrived", "triaged": "triaged", "in-progress": "in_progress", "active": "in_progress",
    "onleave": "on_leave", "finished": "finished", "completed": "finished", "discharged": "finished", "cancelled": "cancelled", "canceled": "cancelled",
    "no-show": "no_show", "noshow": "no_show", "entered-in-error": "error",
}
DIAGNOSIS_SYSTEM = {
    "ICD10": "ICD-10-CM", "ICD-10": "ICD-10-CM", "ICD10CM": "ICD-10-CM", "ICD-10-CM": "ICD-10-CM", "ICD9": "ICD-9-CM", "ICD-9": "ICD-9-CM", "ICD9CM": "ICD-9-CM",
    "ICD-9-CM": "ICD-9-CM", "SNOMED": "SNOMED-CT", "SNOMED-CT": "SNOMED-CT", "SNOMEDCT": "SNOMED-CT",
}
DIAGNOSIS_TYPE = {
    "principal": "principal", "primary": "principal", "p": "principal", "1": "principal", "admitting": "admitting", "a": "admitting", "secondary": "secondary",
    "s": "secondary", "2": "secondary", "working": "working", "final": "final", "discharge": "final",
}
PRESENT_ON_ADMISSION = {"Y": "Y", "YES": "Y", "TRUE": "Y", "1": "Y", "N": "N", "NO": "N", "FALSE": "N", "0": "N", "U": "U", "UNKNOWN": "U", "W": "W", "UNABLE": "W"}
CHAPTERS = {
    "A": "Infectious and parasitic diseases", "B": "Infectious and parasitic diseases", "C": "Neoplasms", "D": "Blood diseases / Neoplasms",
    "E": "Endocrine, nutritional and metabolic diseases", "F": "Mental and behavioral disorders", "G": "Nervous system diseases", "H": "Eye and ear diseases",
    "I": "Circulatory system diseases", "J": "Respiratory system diseases", "K": "Digestive system diseases", "L": "Skin diseases", "M": "Musculoskeletal diseases",
    "N": "Genitourinary system diseases", "O": "Pregnancy and childbirth", "P": "Perinatal conditions", "Q": "Congenital malformations", "R": "Abnormal findings",
    "S": "Injury and poisoning", "T": "Injury and poisoning", "V": "External causes", "W": "External causes", "X": "External causes", "Y": "External causes",
    "Z": "Health status factors",
}
DIAGNOSIS_CODES = [(r"^[A-TV-Z]\d", "ICD-10-CM"), (r"^[A-HJ-NP-Z0-9]{7}$", "ICD-10-PCS"), (r"^[VE]?\d{3,5}$", "ICD-9-CM"), (r"^\d{6,18}$", "SNOMED-CT")]
PROCEDURE_SYSTEM = {
    "CPT": "CPT-4", "CPT4": "CPT-4", "CPT-4": "CPT-4", "HCPCS": "HCPCS", "ICD10PCS": "ICD-10-PCS", "ICD-10-PCS": "ICD-10-PCS", "ICD10-PCS": "ICD-10-PCS",
    "ICD9": "ICD-9-CM", "ICD-9": "ICD-9-CM", "SNOMED": "SNOMED-CT", "SNOMED-CT": "SNOMED-CT",
}
PROCEDURE_STATUS = {
    "preparation": "preparation", "prep": "preparation", "in-progress": "in_progress", "in progress": "in_progress", "active": "in_progress", "not-done": "not_done",
    "cancelled": "not_done", "on-hold": "on_hold", "stopped": "stopped", "completed": "completed", "done": "completed", "finished": "completed", "entered-in-error": "error",
}
PROCEDURE_CODES = [(r"^\d{5}$", "CPT-4"), (r"^[A-Z]\d{4}$", "HCPCS"), (r"^[A-Z0-9]{7}$", "ICD-10-PCS"), (r"^\d{2,4}$", "ICD-9-CM")]
CPT_CATEGORIES = [
    (0, 99, "Anesthesia"), (100, 1999, "Anesthesia"), (10000, 19999, "Integumentary"), (20000, 29999, "Musculoskeletal"), (30000, 32999, "Respiratory"),
    (33000, 37999, "Cardiovascular"), (38000, 38999, "Hemic/Lymphatic"), (39000, 39599, "Mediastinum/Diaphragm"), (40000, 49999, "Digestive"), (50000, 53899, "Urinary"),
    (54000, 55899, "Male Genital"), (55900, 59899, "Female Genital"), (60000, 60699, "Endocrine"), (61000, 64999, "Nervous"), (65000, 68899, "Eye/Ocular"),
    (69000, 69979, "Auditory"), (70000, 79999, "Radiology"), (80000, 89999, "Pathology/Lab"), (90000, 99499, "Medicine/E&M"), (99500, 99607, "Home Services"),
]
#: test: low, high, critical low, critical high. The first name that a test's name contains counts.
LAB_RANGES = {
    "GLUCOSE": (70, 100, 50, 400), "BUN": (7, 20, None, None), "CREATININE": (0.7, 1.3, None, 10), "SODIUM": (136, 145, 120, 160), "POTASSIUM": (3.5, 5.0, 2.5, 6.5),
    "CHLORIDE": (98, 106, None, None), "CO2": (23, 29, None, None), "CALCIUM": (8.5, 10.5, 6.0, 13.0), "ALBUMIN": (3.5, 5.0, None, None), "BILIRUBIN": (0.1, 1.2, None, None),
    "ALT": (7, 56, None, None), "AST": (10, 40, None, None), "ALP": (44, 147, None, None), "WBC": (4.5, 11.0, 2.0, 30.0), "RBC": (4.5, 5.5, None, None),
    "HEMOGLOBIN": (12.0, 17.5, 7.0, None), "HEMATOCRIT": (36, 50, 20, None), "PLATELET": (150, 400, 50, 1000), "PT": (11, 13.5, None, None), "INR": (0.8, 1.1, None, None),
    "PTT": (25, 35, None, None), "TROPONIN": (0, 0.04, None, 0.1), "BNP": (0, 100, None, None), "HBA1C": (4.0, 5.6, None, None), "TSH": (0.4, 4.0, None, None),
    "PH": (7.35, 7.45, 7.2, 7.6), "PCO2": (35, 45, None, None), "PO2": (80, 100, 40, None), "LACTATE": (0.5, 2.2, None, 4.0),
}
INTERPRETATION = {
    "N": "normal", "NORMAL": "normal", "NL": "normal", "A": "abnormal", "ABNORMAL": "abnormal", "ABN": "abnormal", "H": "high", "HIGH": "high", "HH": "critical_high",
    "CRITICAL HIGH": "critical_high", "L": "low", "LOW": "low", "LL": "critical_low", "CRITICAL LOW": "critical_low", "C": "critical", "CRITICAL": "critical", "AA": "critical",
}
LAB_STATUS = {
    "registered": "registered", "preliminary": "preliminary", "final": "final", "f": "final", "amended": "amended", "corrected": "corrected", "cancelled": "cancelled",
    "canceled": "cancelled", "entered-in-error": "error",
}
LAB_CATEGORIES = {
    "chemistry": ["GLUCOSE", "BUN", "CREATININE", "SODIUM", "POTASSIUM", "CHLORIDE", "CO2", "CALCIUM", "ALBUMIN", "BILIRUBIN", "ALT", "AST", "ALP"],
    "hematology": ["WBC", "RBC", "HEMOGLOBIN", "HEMATOCRIT", "PLATELET", "MCV", "MCH", "MCHC", "RDW"],
    "coagulation": ["PT", "INR", "PTT", "FIBRINOGEN", "D-DIMER"],
    "cardiac": ["TROPONIN", "BNP", "CK-MB", "CK"],
    "metabolic": ["HBA1C", "TSH", "T3", "T4", "LIPID", "CHOLESTEROL", "TRIGLYCERIDE", "HDL", "LDL"],
    "blood_gas": ["PH", "PCO2", "PO2", "LACTATE", "BICARBONATE"],
    "urinalysis": ["UA", "URINE", "PROTEIN", "SPECIFIC GRAVITY"],
    "infectious": ["CULTURE", "PROCALCITONIN", "CRP", "ESR"],
}
PLAUSIBLE_LABS = {"GLUCOSE": (10, 1000), "HEMOGLOBIN": (1, 25), "CREATININE": (0.1, 30), "POTASSIUM": (1, 10), "SODIUM": (100, 180), "WBC": (0, 100)}
#: vital: normal low and high, critical low and high.
VITAL_RANGES = {
    "heart_rate": (60, 100, 40, 150), "respiratory_rate": (12, 20, 8, 30), "systolic_bp": (90, 120, 70, 180), "diastolic_bp": (60, 80, 40, 120),
    "temperature": (97, 99, 95, 104), "oxygen_saturation": (95, 100, 90, 100), "pain_score": (0, 3, 0, 10),
}
VITAL_LIMITS = {
    "heart_rate": (0, 300), "respiratory_rate": (0, 100), "systolic_bp": (0, 300), "diastolic_bp": (0, 200), "temperature": (80, 115), "oxygen_saturation": (0, 100),
    "mean_arterial_pressure": (0, 250), "fio2": (0.21, 1.0), "weight": (0, float("inf")), "height": (0, float("inf")), "bmi": (0, 100), "pain_score": (0, 10),
    "gcs_total": (3, 15), "gcs_eye": (1, 4), "gcs_verbal": (1, 5), "gcs_motor": (1, 6),
}
#: Upper bounds and points, in order; the last bound is open.
NEWS = {
    "respiratory_rate": [(8, 3), (11, 1), (20, 0), (24, 2), (None, 3)],
    "oxygen_saturation": [(91, 3), (93, 2), (95, 1), (None, 0)],
    "temperature": [(95.0, 3), (96.8, 1), (100.4, 0), (102.2, 1), (None, 2)],
    "systolic_bp": [(90, 3), (100, 2), (110, 1), (219, 0), (None, 3)],
    "heart_rate": [(40, 3), (50, 1), (90, 0), (110, 1), (130, 2), (None, 3)],
}
ROUTE = {
    "oral": "oral", "po": "oral", "by mouth": "oral", "iv": "intravenous", "intravenous": "intravenous", "im": "intramuscular", "intramuscular": "intramuscular",
    "sq": "subcutaneous", "sc": "subcutaneous", "subq": "subcutaneous", "subcutaneous": "subcutaneous", "topical": "topical", "top": "topical", "inh": "inhalation",
    "inhalation": "inhalation", "rectal": "rectal", "pr": "rectal", "ophthalmic": "ophthalmic", "otic": "otic", "nasal": "nasal", "transdermal": "transdermal",
    "td": "transdermal", "patch": "transdermal", "sl": "sublingual", "sublingual": "sublingual",
}
MEDICATION_STATUS = {
    "active": "active", "on-hold": "on_hold", "cancelled": "cancelled", "canceled": "cancelled", "completed": "completed", "stopped": "stopped",
    "entered-in-error": "error", "draft": "draft", "unknown": "unknown",
}
MEDICATION_LENGTHS = {"medication_name": 500, "route": 50, "frequency": 100, "dose_unit": 30, "status": 30}
HIGH_ALERT = {
    "anticoagulants": ["warfarin", "heparin", "enoxaparin", "rivaroxaban", "apixaban", "dabigatran"],
    "insulins": ["insulin", "humalog", "novolog", "lantus", "levemir", "tresiba"],
    "opioids": ["morphine", "fentanyl", "hydromorphone", "oxycodone", "methadone", "hydrocodone"],
    "chemotherapy": ["methotrexate", "vincristine", "cyclophosphamide", "doxorubicin"],
    "paralytics": ["succinylcholine", "rocuronium", "vecuronium", "cisatracurium"],
    "concentrated_electrolytes": ["potassium chloride", "sodium chloride 23.4%", "magnesium sulfate"],
}
DRUG_CLASSES = {
    "antihypertensives": ["lisinopril", "amlodipine", "losartan", "metoprolol", "hydrochlorothiazide", "carvedilol"],
    "diabetes": ["metformin", "glipizide", "sitagliptin", "empagliflozin", "insulin"],
    "statins": ["atorvastatin", "simvastatin", "rosuvastatin", "pravastatin"],
    "antibiotics": ["amoxicillin", "azithromycin", "cephalexin", "ciprofloxacin", "levofloxacin", "vancomycin"],
    "antidepressants": ["sertraline", "escitalopram", "fluoxetine", "bupropion", "venlafaxine", "duloxetine"],
    "ppis": ["omeprazole", "pantoprazole", "esomeprazole", "lansoprazole"],
    "nsaids": ["ibuprofen", "naproxen", "meloxicam", "celecoxib", "ketorolac"],
    "benzodiazepines": ["lorazepam", "diazepam", "alprazolam", "clonazepam", "midazolam"],
    "anticonvulsants": ["levetiracetam", "phenytoin", "valproic acid", "carbamazepine", "gabapentin", "pregabalin"],
    "diuretics": ["furosemide", "hydrochlorothiazide", "spironolactone", "bumetanide"],
}
OPIOIDS = ["morphine", "fentanyl", "hydromorphone", "oxycodone", "oxycontin", "hydrocodone", "codeine", "methadone", "tramadol", "buprenorphine", "meperidine", "dilaudid", "percocet", "vicodin", "norco"]
CONTROLLED = ["morphine", "fentanyl", "hydromorphone", "oxycodone", "hydrocodone", "codeine", "methadone", "tramadol", "buprenorphine", "alprazolam", "diazepam", "lorazepam", "clonazepam", "midazolam", "zolpidem", "amphetamine", "methylphenidate", "testosterone", "ketamine"]
ANTICOAGULANTS = ["warfarin", "coumadin", "heparin", "enoxaparin", "lovenox", "rivaroxaban", "xarelto", "apixaban", "eliquis", "dabigatran", "pradaxa", "edoxaban", "fondaparinux", "argatroban"]
#: Doses a day. Longer patterns are looked for first, so that `twice daily` is not `daily`.
DOSES_A_DAY = {
    "once daily": 1, "daily": 1, "qd": 1, "qday": 1, "twice daily": 2, "bid": 2, "three times daily": 3, "tid": 3, "four times daily": 4, "qid": 4, "every 4 hours": 6,
    "q4h": 6, "every 6 hours": 4, "q6h": 4, "every 8 hours": 3, "q8h": 3, "every 12 hours": 2, "q12h": 2, "weekly": 0.14, "biweekly": 0.07, "monthly": 0.03,
}
#: condition: weight, pattern of codes without dots.
CHARLSON = {
    "myocardial_infarction": (1, "^(I21|I22|I25)"), "heart_failure": (1, "^I50"), "peripheral_vascular": (1, "^(I70|I71|I73)"), "cerebrovascular": (1, "^I6[0-9]"),
    "dementia": (1, "^(F00|F01|F02|F03|G30)"), "pulmonary": (1, "^J4[0-7]"), "rheumatic": (1, "^(M05|M06|M32|M33|M34)"), "ulcer": (1, "^K2[5-8]"),
    "mild_liver": (1, "^(K70|K73|K74)"), "diabetes": (1, "^(E10|E11|E13)(|.*[^2-5])$"), "diabetes_complicated": (2, "^(E10|E11|E13).*[2-5]$"), "hemiplegia": (2, "^(G81|G82|G83)"),
    "renal": (2, "^N18"), "malignancy": (2, "^C([0-689]|7[0-689])"), "severe_liver": (3, "^(K72|K76)"), "metastatic": (6, "^(C77|C78|C79|C80)"), "aids": (6, "^B20"),
}
PHI_PATTERNS = {
    "ssn": [r"\b\d{3}[-\s]?\d{2}[-\s]?\d{4}\b", r"\bssn\s*[:=]\s*\d{9}\b"],
    "phone": [r"\b\(?\d{3}\)?[-.\s]?\d{3}[-.\s]?\d{4}\b", r"\b\d{3}[-.\s]\d{4}\b"],
    "email": [r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b"],
    "date_of_birth": [r"\b(?:dob|birth\s*date|date\s*of\s*birth)\s*[:=]\s*[\d/\-]+", r"\b\d{1,2}[-/]\d{1,2}[-/]\d{2,4}\b"],
    "mrn": [r"\b(?:mrn|medical\s*record)\s*[:=#]?\s*[A-Z0-9\-]+", r"\b[A-Z]{2,3}[-]?\d{6,10}\b"],
    "credit_card": [r"\b(?:4\d{3}|5[1-5]\d{2}|6011|3[47]\d{2})[-\s]?\d{4}[-\s]?\d{4}[-\s]?\d{4}\b"],
    "ip_address": [r"\b(?:\d{1,3}\.){3}\d{1,3}\b"],
    "license_number": [r"\b(?:license|dl|driver)\s*#?\s*[:=]?\s*[A-Z0-9\-]+"],
}
PHI_NAMES = {
    "ssn": ["ssn", "social_security", "social_security_number", "ss_number"],
    "phone": ["phone", "telephone", "mobile", "cell", "fax", "phone_number"],
    "email": ["email", "email_address", "e_mail"],
    "date_of_birth": ["dob", "date_of_birth", "birth_date", "birthdate"],
    "mrn": ["mrn", "medical_record_number", "patient_id", "chart_number"],
    "name": ["name", "first_name", "last_name", "middle_name", "patient_name", "full_name", "maiden_name", "legal_name"],
    "address": ["address", "street", "address_line", "city", "zip", "postal_code", "street_address", "home_address"],
}
HL7_GENDER = {"M": "male", "F": "female", "O": "other", "U": "unknown", "A": "other", "N": "unknown"}
HL7_CLASS = {"I": "inpatient", "O": "outpatient", "E": "emergency", "P": "preadmit", "R": "recurring", "B": "obstetrics", "C": "commercial", "N": "not_applicable", "U": "unknown"}
