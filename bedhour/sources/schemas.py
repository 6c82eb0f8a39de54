"""Fixed schemas of the raw tables. Offsets are minutes since unit admission.

Only columns some operator reads are named; ``readers`` takes them by header
name and casts them, so a file may hold more columns in any order.
"""

RAW_SCHEMAS: dict[str, str] = {
    "patient": """
        uniquepid string, patientunitstayid bigint, patienthealthsystemstayid bigint,
        age string, gender string, ethnicity string, hospitaldischargeyear int,
        unitdischargeoffset bigint, unitdischargestatus string,
        admissionheight double, admissionweight double, dischargeweight double""",
    "infusionDrug": """
        infusiondrugid bigint, patientunitstayid bigint, infusionoffset bigint,
        drugname string, drugrate string, infusionrate double, drugamount double,
        volumeoffluid double""",
    "intakeOutput": """
        patientunitstayid bigint, intakeoutputoffset bigint, cellpath string,
        celllabel string, cellvaluenumeric double""",
    "treatment": """
        treatmentid bigint, patientunitstayid bigint, treatmentoffset bigint,
        treatmentstring string""",
    "lab": """
        labid bigint, patientunitstayid bigint, labresultoffset bigint,
        labresult string, labname string, labmeasurenamesystem string""",
    "customLab": """
        customlabid bigint, patientunitstayid bigint, labotheroffset bigint,
        labotherresult string, labothername string""",
    "nurseCharting": """
        nursingchartid bigint, patientunitstayid bigint, nursingchartoffset bigint,
        nursingchartvalue string, nursingchartcelltypevallabel string""",
    "respiratoryCharting": """
        respchartid bigint, patientunitstayid bigint, respchartoffset bigint,
        respchartentryoffset bigint, respcharttypecat string,
        respchartvaluelabel string, respchartvalue string""",
    "vitalPeriodic": """
        vitalperiodicid bigint, patientunitstayid bigint, observationoffset bigint,
        temperature double, sao2 double, heartrate double, respiration double,
        cvp double, etco2 double, systemicsystolic double, systemicdiastolic double""",
    "vitalAperiodic": """
        vitalaperiodicid bigint, patientunitstayid bigint, observationoffset bigint,
        noninvasivesystolic double, noninvasivediastolic double, paop double,
        cardiacoutput double""",
    "microLab": """
        microlabid bigint, patientunitstayid bigint, culturetakenoffset bigint,
        culturesite string, antibiotic string""",
    "diagnosis": """
        patientunitstayid bigint, diagnosisoffset bigint, icd9code string""",
}
