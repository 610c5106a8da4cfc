"""Raw records of any source as canonical, typed columns: alternate field names, and texts parsed.

What comes out is what the standard forms take, so files, bundles and messages can be passed on to them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as st

from wardlake.functions.dates import parse_date, parse_time
from wardlake.functions.lookup import filled
from wardlake.operators import standardise

#: Canonical fields, their kinds, and what sources call them, in order of preference.
FIELDS = {
    "patients": {
        "patient_id": ("text", ["patient_id", "source_id"]), "mrn": ("text", ["mrn"]), "first_name": ("text", ["first_name"]), "last_name": ("text", ["last_name"]),
        "date_of_birth": ("text", ["date_of_birth", "dob"]), "gender": ("text", ["gender", "sex"]), "address_line1": ("text", ["address_line1", "address"]), "state": ("text", ["state"]),
        "postal_code": ("text", ["postal_code", "zip"]), "country": ("text", ["country"]), "phone": ("text", ["phone"]), "email": ("text", ["email"]), "ssn": ("text", ["ssn"]), "marital_status": ("text", ["marital_status"]),
    },
    "encounters": {
        "encounter_id": ("text", ["encounter_id", "source_id"]), "patient_id": ("text", ["patient_id"]), "encounter_type": ("text", ["encounter_type", "class"]), "status": ("text", ["status"]),
        "admission_date": ("time", ["admission_date", "arrival_date"]), "discharge_date": ("time", ["discharge_date", "departure_date"]), "location": ("text", ["location"]), "department": ("text", ["department", "unit"]),
        "facility": ("text", ["facility", "hospital"]), "attending_provider": ("text", ["attending_provider", "provider"]), "admit_source": ("text", ["admit_source"]), "discharge_disposition": ("text", ["discharge_disposition"]),
        "primary_diagnosis_code": ("text", ["primary_diagnosis_code"]), "drg_code": ("text", ["drg_code"]), "financial_class": ("text", ["financial_class", "payer_class"]), "total_charges": ("number", ["total_charges"]),
    },
    "diagnoses": {
        "source_id": ("text", ["source_id"]), "encounter_id": ("text", ["encounter_id"]), "patient_id": ("text", ["patient_id"]), "rank": ("whole", ["rank"]), "code": ("text", ["code"]), "code_system": ("text", ["code_system"]),
        "description": ("text", ["description"]), "diagnosis_type": ("text", ["diagnosis_type", "type"]), "present_on_admission": ("text", ["present_on_admission"]), "onset_date": ("date", ["onset_date"]),
    },
    "procedures": {
        "source_id": ("text", ["source_id"]), "encounter_id": ("text", ["encounter_id"]), "patient_id": ("text", ["patient_id"]), "code": ("text", ["code"]), "code_system": ("text", ["code_system"]), "status": ("text", ["status"]),
        "duration_minutes": ("whole", ["duration_minutes"]), "performed_date": ("time", ["performed_date"]), "charges": ("number", ["charges"]),
    },
    "labs": {
        "source_id": ("text", ["source_id"]), "patient_id": ("text", ["patient_id"]), "test_name": ("text", ["test_name", "description"]), "value": ("text", ["value"]), "value_unit": ("text", ["value_unit", "unit"]),
        "reference_range_low": ("measure", ["reference_range_low"]), "reference_range_high": ("measure", ["reference_range_high"]), "interpretation": ("text", ["interpretation", "abnormal_flag"]), "status": ("text", ["status"]),
        "effective_date": ("time", ["effective_date"]),
    },
    "vitals": {
        "source_id": ("text", ["source_id"]), "patient_id": ("text", ["patient_id"]), "recorded_date": ("time", ["recorded_date", "effective_date"]), "heart_rate": ("number", ["heart_rate", "pulse"]),
        "respiratory_rate": ("number", ["respiratory_rate", "resp_rate"]), "systolic_bp": ("number", ["systolic_bp", "sbp"]), "diastolic_bp": ("number", ["diastolic_bp", "dbp"]), "mean_arterial_pressure": ("number", ["mean_arterial_pressure", "map"]),
        "temperature": ("number", ["temperature", "temp"]), "oxygen_saturation": ("number", ["oxygen_saturation", "spo2"]), "oxygen_device": ("text", ["oxygen_device"]), "fio2": ("number", ["fio2"]), "weight": ("number", ["weight"]),
        "weight_unit": ("text", ["weight_unit"]), "height": ("number", ["height"]), "height_unit": ("text", ["height_unit"]), "bmi": ("number", ["bmi"]), "pain_score": ("whole", ["pain_score", "pain"]), "gcs_total": ("whole", ["gcs_total", "gcs"]),
        "gcs_eye": ("whole", ["gcs_eye"]), "gcs_verbal": ("whole", ["gcs_verbal"]), "gcs_motor": ("whole", ["gcs_motor"]),
    },
    "medications": {
        "encounter_id": ("text", ["encounter_id"]), "line": ("text", ["line", "source_id"]), "medication_name": ("text", ["medication_name", "drug_name"]), "status": ("text", ["status"]), "dose_value": ("text", ["dose_value", "dose"]),
        "dose_unit": ("text", ["dose_unit"]), "route": ("text", ["route"]), "frequency": ("text", ["frequency", "sig"]), "prn": ("text", ["prn"]), "start_date": ("date", ["start_date"]), "end_date": ("date", ["end_date"]),
        "authored_date": ("time", ["authored_date", "order_date"]), "prescriber": ("text", ["prescriber", "ordering_provider"]), "quantity": ("number", ["quantity"]), "refills": ("whole", ["refills"]), "days_supply": ("whole", ["days_supply"]),
    },
}


def value(c: Column, have: st.DataType, kind: str) -> Column:
    """The column as that kind; what cannot be read as it is null."""
    if kind == "text":
        return filled(c)
    if kind in ("time", "date"):
        if isinstance(have, st.StringType):
            return parse_time(c).cast("timestamp_ntz") if kind == "time" else F.coalesce(parse_date(c), F.to_date(parse_time(c)))
        return c.cast("timestamp_ntz" if kind == "time" else "date")
    number = standardise.lab_number(c) if kind == "measure" else F.trim(c.cast("string")).try_cast("double")
    return number.cast("int") if kind == "whole" else number


def canonical(df: DataFrame, kind: str) -> DataFrame:
    """The canonical columns of that kind of record, all of them; names are compared without case. Of several names for one
    the first that is filled counts; a zero in a numeric column is not filled while another name may be. Other columns are
    left out."""
    have = {f.name.lower(): f for f in df.schema.fields}
    out = []
    for to, (how, names) in FIELDS[kind].items():
        found = [have[n] for n in names if n in have]
        cols = []
        for k, f in enumerate(found):
            c = F.col(f"`{f.name}`")
            if k + 1 < len(found) and isinstance(f.dataType, st.NumericType):
                c = F.nullif(c, F.lit(0))
            cols.append(value(c, f.dataType, how))
        none = {"time": "timestamp_ntz", "date": "date", "number": "double", "measure": "double", "whole": "int", "text": "string"}[how]
        out.append((F.coalesce(*cols) if cols else F.lit(None).cast(none)).alias(to))
    return df.select(*out)


def standard(df: DataFrame, kind: str, **how) -> DataFrame:
    """Raw records in standard form, with `_errors`."""
    return getattr(standardise, kind)(canonical(df, kind), **how)
