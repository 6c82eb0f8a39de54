"""bedhour: hourly intensive-care feature tables built with Spark DataFrames."""

STAY = "patientunitstayid"
PATIENT = "uniquepid"

__all__ = ["STAY", "PATIENT"]
