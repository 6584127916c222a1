"""Concept ids, check names and thresholds that the results depend on."""

# Concepts that stand for "no information", "other", "unknown" and unmapped.
NULL_CONCEPTS = (44814650, 0, 44814653, 44814649)

# The same without 0, as used for sex.
UNINFORMATIVE_SEX = (44814650, 44814653, 44814649)

# Visit concepts.
OFFICE_VISIT = 9202
OUTPATIENT_VISITS = (9202, 581399)
INPATIENT_VISITS = (9201, 2000000048)
FACE_TO_FACE_VISITS = (9201, 9202, 9203, 581399, 2000000048)
CANCELLED_VISIT_SOURCE = 2000001590

# Intensive care services.
ICU_SERVICES = (2000000079, 2000000080, 2000000078)

# Drug record types.
PRESCRIPTION = 38000177
INPATIENT_ADMINISTRATION = 38000180

# Fixed value: the specialty that is used only when nothing more specific is known.
GENERAL_SPECIALTY = 38004477

# Short check type, long check type, category.
CHECK_TYPES = (
    ("dc", "Data Cycle Changes", "Consistency"),
    ("ecp", "Expected Concepts Present", "Correctness"),
    ("bmc", "Best Mapped Concepts", "Correctness"),
    ("dcon", "Domain Concordance", "Concordance"),
    ("cfd", "Person Facts/Records", "Completeness"),
    ("mf_visitid", "Missing Field: Visit ID", "Completeness"),
    ("fot", "Facts Over Time", "Consistency"),
    ("uc", "Unmapped Concepts", "Completeness"),
    ("vc", "Vocabulary Conformance", "Conformance"),
    ("vs", "Value Set Conformance", "Conformance"),
    ("dp", "Date Plausibility", "Correctness"),
)

# Gestational age labels.
GESTATION_UNKNOWN = "Null/0 Gestational Age"
GESTATION_EXPECTED = "20-45 Weeks (Expected Range)"
GESTATION_SHORT = "Less than 20 weeks (Short Term)"
GESTATION_LONG = "Greater than 45 weeks (Long Term)"

# Digits of a complete census tract and block group code.
TRACT_DIGITS = 11
BLOCK_GROUP_DIGITS = 12
