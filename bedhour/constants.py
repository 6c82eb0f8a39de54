"""Values fixed by the clinical definition of the data set.

All tables here are fixed values: word lists, unit factors, default values and
code prefixes that must be exactly these for the results to be right.
"""

# Units after which an infusion's end can be computed.
INFUSION_UNITS = [
    "mcg/kg/min",
    "mcg/min",
    "ml/hr",
    "mg/min",
    "units/hr",
    "mg/hr",
    "units/min",
    "mcg/kg/hr",
    "mcg/hr",
    "mg/kg/min",
    "Unknown",
    "Aviva",
    "mg/kg/hr",
    "nanograms/kg/min",
    "units/kg/hr",
    "Scale B",
    "Scale A",
    "mL",
    "Human",
    "ml",
    "ARTERIAL LINE",
    "BNP",
    "units/kg/min",
]

# Density and scale per drug, for millilitre amounts and rates.
DRUG_DENSITY = {
    "Norepinephrine": (1.4, 1000),
    "Epinephrine": (1.3, 1000),
    "Dopamine": (1.26, 1000),
    "Dobutamine": (12.5, 1),
    "Phenylephrine": (1.275, 1000),
    "Vasopressin": (1.6, 1000),
    "Labetalol": (1.2, 1000),
    "Milrinone": (1.344, 1000),
}

# Drugs whose millilitre rate can be converted.
RATE_DRUGS = [
    "Norepinephrine",
    "Epinephrine",
    "Dopamine",
    "Dobutamine",
    "Phenylephrine",
    "Vasopressin",
    "Milrinone",
]

# Units per milligram, millilitres per unit, units per microgram.
UNITS_PER_MG = 530
ML_PER_UNIT = 100
UNITS_PER_MCG = 0.0256

# What a missing measurement is taken to be.
DEFAULTS = {
    "NIBPs": 125,
    "O2 Sat (%)": 65,
    "Respiratory Rate": 12,
    "HR": 70,
    "NIBPd": 75,
    "SaO2": 94,
    "Temperature": 36.5,
    "RASS": 0,
    "ABPs": 125,
    "PEEP": 0,
    "Peak Insp. Pressure": 0,
    "ABPd": 75,
    "CVP": 4,
    "Verbal Response": 5,
    "Motor Response": 6,
    "EtCO2": 40,
    "Eye Opening": 4,
    "SVO2": 70,
    "Stroke Volume": 50,
    "PAOP": 20,
    "SpO2": 95,
    "ECMO": 0,
    "Lactate": 1.1,
    "Sodium": 135,
    "Creatinine": 0.7,
    "Anion gap": 10,
    "Glucose": 5,
    "Potassium": 4,
    "pH": 7,
    "PaCO2": 40,
    "Ca+": 8.5,
    "Hemoglobin": 12,
    "PaO2": 75,
    "Alkaline phosphatase": 85,
    "BUN": 23,
    "ALT": 25,
    "AST": 25,
    "FIO2 (%)": 21,
    "CO2": 25,
    "INR": 1,
    "Total Bilirubin": 2,
    "RedBloodCell": 3.5,
    "Hematocrit": 42,
    "Platelets": 300,
    "WBC": 10,
    "Tropinin-T": 0,
    "CRP": 4,
}

# Diagnosis groups by prefix of the second (ICD-10) code.
DIAGNOSIS_PREFIXES = {
    "Acute_Myocardial_Infarction": ["I21", "I22"],
    "End-Stage_Cardiomyopathy": ["I42"],
    "Adv__Valvular_HD": ["I34", "I35", "I36", "I37", "I38", "I39"],
    "Myocarditis": ["I40", "I51.4"],
    "Arrhythmia": ["I47", "I48", "I49"],
    "spinal_cord_injury": ["G50", "805", "806"],
    "Pulmonary_Embolism": ["I26"],
    "Tension_Pneumothorax": ["J93"],
    "hypovolemia_external": ["S", "T"],
    "hypovolemia_internal": ["I60", "I61", "I62", "I63", "I64", "I65", "I66", "I67", "I68", "I69"],
}

# Totals that make a stay-hour vasoactive.
VASOACTIVE = [
    "Norepinephrine (MG)",
    "Epinephrine (MG)",
    "Dopamine (MG)",
    "Dobutamine (MG)",
    "Phenylephrine (MG)",
    "Vasopressin (MG)",
    "Milrinone (MG)",
    "med_Nitroprusside",
]

# Labels a stay must have at least once.
REQUIRED_ITEMS = ["Lactate", "ABPs", "ABPd"]

# Treatment texts that mean a culture was taken.
CULTURE_TREATMENTS = [
    "infectious diseases|cultures / immuno-assays|cultures|blood",
    "infectious diseases|cultures / immuno-assays|cultures|blood|drawn from central line",
    "infectious diseases|cultures / immuno-assays|cultures",
    "infectious diseases|cultures / immuno-assays|cultures|blood|peripheral",
    "infectious diseases|cultures / immuno-assays|cultures|catheter tip",
    "infectious diseases|cultures / immuno-assays|cultures|BAL/PBS|bacterial",
    "infectious diseases|cultures / immuno-assays|cultures|BAL/PBS|comprehensive (bacterial, viral, fungal, afb, etc.",
    "surgery|infection|cultures|surgical specimen",
    "infectious diseases|procedures|vascular catheter - change|tip cultured",
    "surgery|infection|cultures|blood",
    "infectious diseases|procedures|vascular catheter - removal|tip cultured",
    "infectious diseases|cultures / immuno-assays|cultures|pericardial fluid",
    "surgery|infection|cultures|blood|peripheral",
    "infectious diseases|cultures / immuno-assays|warm-reactive antibody",
    "infectious diseases|cultures / immuno-assays|cold-reactive antibody",
    "infectious diseases|cultures / immuno-assays|cultures|catheter tip|quantitative",
]

# Intake labels that are antibiotics.
ANTIBIOTIC_LABELS = [
    "vanco3.96 mg/ml (ml/hr)",
    "vanco0.40mg/ml (ml/hr)",
    "vanco 0.04 mg/ml (ml/hr)",
    "NS with antibiotics (ml/hr)",
    "NSS with anti (ml/hr)",
    "NS antibx (ml/hr)",
    "antibiotics (ml/hr)",
    "antibiotic (ml/hr)",
    "Volume (mL)-vancomycin 1,250 mg in sodium chloride 0.9% 250 mL IVPB",
    "Volume (mL)-vancomycin 1,500 mg in sodium chloride 0.9% 250 mL IVPB",
    "Volume (mL)-vancomycin (VANCOCIN) 750 mg in sodium chloride 0.9 % 250 mL IVPB",
    "vanco",
    "vancomycin",
    "Volume (mL)-vancomycin (VANCOCIN) IVPB 750 mg/150 ml premix",
    "Volume (mL)-vancomycin (VANCOCIN) IVPB 1000 mg/200 mL premix",
    "Volume (mL)-vancomycin (VANCOCIN) 2,000 mg in sodium chloride 0.9 % 500 mL IVPB",
    "Volume (mL)-vancomycin (VANCOCIN) 1,250 mg in sodium chloride 0.9 % 250 mL IVPB",
    "Volume (mL)-vancomycin (VANCOCIN) 500 mg in sodium chloride 0.9 % 100 mL IVPB",
    "Volume (mL)-vancomycin (VANCOCIN) 1,500 mg in sodium chloride 0.9 % 500 mL IVPB",
    "Volume (mL)-vancomycin (VANCOCIN) 750 mg in sodium chloride 0.9 % 150 mL IVPB",
    "Volume (mL)-vancomycin (VANCOCIN) 1,500 mg in sodium chloride 0.9 % 250 mL IVPB",
    "Volume (mL)-vancomycin (VANCOCIN) 1,750 mg in sodium chloride 0.9 % 500 mL IVPB",
    "Volume (mL)-vancomycin in dextrose premix 1 g",
    "Volume (mL)-vancomycin (VANCOCIN) 1,500 mg in dextrose 5 % 250 mL IVPB",
    "Volume (mL)-vancomycin (VANCOCIN) 1,750 mg in dextrose 5 % 500 mL IVPB",
    "Volume (mL)-vancomycin in dextrose premix 1,000 mg",
    "Volume (mL)-vancomycin (VANCOCIN) 1,250 mg in dextrose 5 % 250 mL IVPB",
    "Volume (mL)-vancomycin (VANCOCIN) 750 mg in dextrose 5 % 250 mL IVPB",
    "Volume (mL)-meropenem (MERREM) 500 mg in sodium chloride 0.9 % 100 mL IVPB",
    "Volume (mL)-meropenem (MERREM) 1 g in sodium chloride 0.9 % 100 mL IVPB",
    "Volume (mL)-meropenem (MERREM) 2 g in sodium chloride 0.9 % 100 mL IVPB",
    "meropenem",
    "Volume (mL)-imipenem-cilastatin (PRIMAXIN) 250 mg in sodium chloride 0.9 % 100 mL IVPB",
    "Volume (mL)-imipenem-cilastatin (PRIMAXIN) 500 mg in sodium chloride 0.9 % 100 mL IVPB",
    "Volume (mL)-piperacillin-tazobactam (ZOSYN) 3.375 g in sodium chloride 0.9 % 100 mL IVPB",
    "Volume (mL)-piperacillin-tazobactam (ZOSYN) 4.5 g in sodium chloride 0.9 % 100 mL IVPB",
    "Volume (mL)-piperacillin-tazobactam (ZOSYN) in dextrose 5% premix IVPB 3.375 g",
    "Volume (mL)-piperacillin-tazobactam (ZOSYN) IVPB 3.375 g",
    "Volume (mL)-piperacillin-tazobactam (ZOSYN) IVPB 2.25 g",
    "Volume (mL)-piperacillin-tazobactam (ZOSYN) IVPB 4.5 g",
    "Volume (mL)-piperacillin-tazobactam (ZOSYN) FOUR HOUR EXTENDED INFUSION IVPB 3.375 g",
    "Volume (mL)-piperacillin-tazobactam (ZOSYN) 3.375 g in sodium chloride 0.9 % 100 mL thirty minute IVPB",
    "Volume (mL)-piperacillin-tazobactam (ZOSYN) 3.375 g in sodium chloride 0.9 % 100 mL FOUR HOUR EXTENDED INFUSION IVPB",
    "Volume (mL)-piperacillin-tazobactam (ZOSYN) 3.375 g in sodium chloride 0.9 % 100 mL EXTENDED INFUSION IVPB",
    "Volume (mL)-piperacillin-tazobactam (ZOSYN) 2.25 g in sodium chloride 0.9 % 100 mL IVPB",
    "Volume (mL)-piperacillin-tazobactam (ZOSYN) thirty minute IVPB 4.5 g",
    "Volume (mL)-piperacillin-tazobactam (ZOSYN) 4.5 g in sodium chloride 0.9 % 100 mL thirty minute IVPB",
    "Volume (mL)-tigecycline (TYGACIL) 50 mg in sodium chloride 0.9 % 100 mL IVPB",
    "Volume (mL)-ciprofloxacin (CIPRO) 400 mg in dextrose 5% 200 mL IVPB",
    "Volume (mL)-ciprofloxacin (CIPRO) IVPB 400 mg",
    "Volume (mL)-clindamycin 900 mg in sodium chloride 0.9% 50 mL IVPB",
    "Volume (mL)-clindamycin 600 mg in sodium chloride 0.9% 50 mL IVPB",
    "Volume (mL)-clindamycin (CLEOCIN) IVPB 900 mg",
    "Volume (mL)-clindamycin (CLEOCIN) IVPB 600 mg",
    "Volume (mL)-doxycycline (VIBRAMYCIN) 100 mg in sodium chloride 0.9 % 250 mL IVPB",
    "Volume (mL)-doxycycline (VIBRAMYCIN) 100 mg in dextrose 5 % 250 mL IVPB",
    "Volume (mL)-ampicillin-sulbactam (UNASYN) 3 g in sodium chloride 0.9 % 100 mL IVPB",
    "Volume (mL)-ampicillin (OMNIPEN) 2,000 mg in sodium chloride 0.9 % 100 mL IVPB",
    "Volume (mL)-ampicillin-sulbactam (UNASYN) 1.5 g in sodium chloride 0.9 % 100 mL IVPB",
    "Volume (mL)-ampicillin (OMNIPEN) 2 g in sodium chloride 0.9 % 50 mL IVPB",
    "Volume (mL)-ampicillin-sulbactam (UNASYN) 1.5 g in sodium chloride 0.9 % 50 mL IVPB",
    "Volume (mL)-ampicillin (OMNIPEN) 12 g in sodium chloride 0.9 % 500 mL IVPB",
    "Volume (mL)-ampicillin (OMNIPEN) 2 g in sodium chloride 0.9 % 100 mL IVPB",
    "Volume (mL)-azithromycin (ZITHROMAX) 500 mg in sodium chloride 0.9 % 250 mL IVPB",
    "Volume (mL)-azithromycin (ZITHROMAX) 500 mg in dextrose 5 % 250 mL IVPB",
    "Volume (mL)-erythromycin (ERYTHROCIN) 250 mg in sodium chloride 0.9 % 100 mL IVPB",
    "Volume (mL)-fluconazole (DIFLUCAN) IVPB 200 mg",
    "Volume (mL)-fluconazole (DIFLUCAN) IVPB 400 mg",
    "Volume (mL)-fluconazole (DIFLUCAN) IVPB 100 mg",
    "Volume (mL)-levofloxacin (LEVAQUIN) in dextrose 5% premix IVPB 750 mg",
    "Volume (mL)-levofloxacin (LEVAQUIN) in dextrose 5% premix IVPB 500 mg",
    "Volume (mL)-levofloxacin (LEVAQUIN) IVPB 500 mg",
    "Volume (mL)-levofloxacin (LEVAQUIN) IVPB 750 mg",
    "Volume (mL)-linezolid (ZYVOX) IVPB 600 mg",
    "Volume (mL)-nafcillin (NAFCIL) 2,000 mg in sodium chloride 0.9 % 100 mL IVPB",
    "nafcillin 500mg/hr",
    "Volume (mL)-penicillin G potassium 2.5 Million Units in dextrose 5 % 100 mL IVPB",
]
