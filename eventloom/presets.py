"""Specifications of five public event logs."""

from __future__ import annotations

from eventloom.spec import LogSpec

# Column names, activities and texts of the public logs

XES_NAMES = {
    "case:concept:name": "Case ID",
    "concept:name": "Activity",
    "org:resource": "Resource",
    "org:role": "Role",
    "time:timestamp": "timestamp",
}

ROAD_TRAFFIC_FINES = LogSpec(
    case="Case ID",
    activity="Activity",
    timestamp="Complete Timestamp",
    dynamic_categorical=("Activity", "Resource", "lastSent", "notificationType", "dismissal"),
    static_categorical=("article", "vehicleClass"),
    dynamic_numeric=("expense", "timesincecasestart", "remaining_time_minutes"),
    static_numeric=("amount", "points"),
    rename={**XES_NAMES, "time:timestamp": "Complete Timestamp"},
    strip_text="(case) ",
    complete_with=("Payment", "Send for Credit Collection"),
    label_activity="Send for Credit Collection",
    only_configured=True,
    drop_before_discretize=("timesincecasestart", "Resource"),
    sentinels=("missing", "NIL"),
    keep_as_category=("article", "vehicleClass"),
)

LOAN_APPLICATIONS = LogSpec(
    case="case:concept:name",
    activity="concept:name",
    timestamp="time:timestamp",
    dynamic_categorical=("concept:name", "org:resource", "lifecycle:transition"),
    dynamic_numeric=(
        "timesincemidnight",
        "timesincelastevent",
        "timesincecasestart",
        "event_nr",
        "month",
        "weekday",
        "hour",
        "open_cases",
        "remaining_time_minutes",
    ),
    static_numeric=("AMOUNT_REQ",),
    rename={"case:AMOUNT_REQ": "AMOUNT_REQ"},
    strip_text="(case) ",
    group_rare_activity=True,
    with_open_cases=True,
    only_configured=True,
    drop_before_discretize=("org:resource",),
)

SEPSIS = LogSpec(
    case="Case ID",
    activity="Activity",
    timestamp="timestamp",
    dynamic_categorical=("Activity", "org:group"),
    static_categorical=(
        "Diagnose",
        "DiagnosticArtAstrup",
        "DiagnosticBlood",
        "DiagnosticECG",
        "DiagnosticIC",
        "DiagnosticLacticAcid",
        "DiagnosticLiquor",
        "DiagnosticOther",
        "DiagnosticSputum",
        "DiagnosticUrinaryCulture",
        "DiagnosticUrinarySediment",
        "DiagnosticXthorax",
        "DisfuncOrg",
        "Hypotensie",
        "Hypoxie",
        "InfectionSuspected",
        "Infusion",
        "Oligurie",
        "SIRSCritHeartRate",
        "SIRSCritLeucos",
        "SIRSCritTachypnea",
        "SIRSCritTemperature",
        "SIRSCriteria2OrMore",
    ),
    dynamic_numeric=("CRP", "LacticAcid", "Leucocytes", "remaining_time_minutes"),
    static_numeric=("Age",),
    rename=XES_NAMES,
    complete_with=("Release A", "Release B", "Release C", "Release D", "Release E"),
    drop_before_discretize=("org:group", "Age"),
)

INTERNATIONAL_DECLARATIONS = LogSpec(
    case="Case ID",
    activity="Activity",
    timestamp="timestamp",
    dynamic_categorical=("Activity", "Resource", "Role"),
    static_categorical=(
        "DeclarationNumber",
        "Permit travel permit number",
        "travel permit number",
        "Permit TaskNumber",
        "Permit BudgetNumber",
        "Permit ProjectNumber",
        "Permit OrganizationalEntity",
        "Permit ID",
        "Permit id",
        "BudgetNumber",
    ),
    dynamic_numeric=("remaining_time_minutes",),
    static_numeric=("Amount", "RequestedAmount", "OriginalAmount", "Permit RequestedBudget", "AdjustedAmount"),
    rename=XES_NAMES,
    strip_prefix="case:",
    normalize_spellings=True,
    drop_before_discretize=("Resource", "Role"),
)

TRAVEL_PERMITS = LogSpec(
    case="Case ID",
    activity="Activity",
    timestamp="timestamp",
    dynamic_categorical=("Activity", "Resource", "Role"),
    static_categorical=(
        "OrganizationalEntity",
        "ProjectNumber",
        "TaskNumber",
        "ActivityNumber",
        "Permit",
        "travel permit number",
        "BudgetNumber",
        "Overspent",
        "DeclarationNumber_0",
        "RfpNumber_0",
        "Cost Type_0",
        "Task_0",
        "Project_0",
    ),
    dynamic_numeric=("Amount", "RequestedAmount", "remaining_time_minutes"),
    static_numeric=("TotalDeclared", "RequestedAmount_0", "RequestedBudget", "OverspentAmount"),
    rename=XES_NAMES,
    strip_prefix="case:",
    normalize_spellings=True,
    boolean_text=("Overspent",),
    drop_before_discretize=("Resource", "Role", "Task_0", "RfpNumber_0"),
    sentinels=("missing",),
)

PRESETS = {
    "rtf": ROAD_TRAFFIC_FINES,
    "bpi12": LOAN_APPLICATIONS,
    "sepsis": SEPSIS,
    "intDecl": INTERNATIONAL_DECLARATIONS,
    "permit": TRAVEL_PERMITS,
}
