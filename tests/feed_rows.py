"""A feed row that breaks no rule."""

GOOD = dict(
    claim_id="C00", ndc="00001-0001-01", drug_name_raw="drg one", pharmacy_id="P1", state_raw="New York", patient_gender="male",
    patient_age="40", prescriber_npi="N1", date_written="2025-01-05", date_filled="01/07/2025", quantity_dispensed="30",
    days_supply="30", unit_price="10.00", total_paid="300.00",
)
