"""A small directory of nested exports with every edge row the loaders must handle."""

import json


def write_exports(root):
    def put(path, results, meta=None):
        target = root / path
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_text(json.dumps({"meta": meta or {}, "results": results}, indent=1))

    openfda = {
        "device_name": "Infusion Pump",
        "medical_specialty_description": "General Hospital",
        "regulation_number": "880.5725",
        "device_class": "2",
    }
    device = {
        "brand_name": " ACME Pump ",
        "manufacturer_d_name": "ACME Inc.",
        "date_received": "20240105",
        "openfda": openfda,
    }
    events = [
        {
            "mdr_report_key": "100",
            "event_type": "Injury (IN)",
            "date_of_event": "20240131",
            "date_received": "2024-02-01",
            "event_location": " ",
            "report_to_fda": "\\",
            "report_number": "NULL",
            "product_problems": ["Leak", "", " Alarm "],
            "remedial_action": [""],
            "patient": [
                {
                    "patient_sequence_number": "1",
                    "patient_age": "44",
                    "patient_problems": ["Burn", "Pain"],
                    "sequence_number_outcome": ["1. Hospitalization", "Recovered nicely"],
                    "sequence_number_treatment": ["Surgery"],
                }
            ],
            "device": [device, {"brand_name": "No openfda"}],
            "mdr_text": [
                {"mdr_text_key": "7", "patient_sequence_number": "1", "text": "Pump LEAKED\\\\"},
                {"mdr_text_key": "seven", "text": "bad key"},
            ],
        },
        {"mdr_report_key": "101", "event_type": "Death", "patient": [], "device": [device]},
        {
            "mdr_report_key": "102",
            "date_of_event": "20241301",
            "device": [device],
            "mdr_text": [{"mdr_text_key": "8", "text": "orphan"}],
        },
        {"mdr_report_key": None, "event_type": "Other"},
        {"mdr_report_key": None, "event_type": "Malfunction"},
    ]
    put("2024/device-event-0001.json", events)
    put(
        "2024/device-event-0002.json",
        [
            {
                "mdr_report_key": "101",
                "event_type": "Other",
                "device": [device],
                "mdr_text": [{"mdr_text_key": "7", "text": "duplicate narrative"}],
            }
        ],
    )
    put(
        "recalls/recall-0001.json",
        [
            {
                "cfres_id": "1",
                "event_date_posted": "2024-03-01",
                "recalling_firm": "ACME GmbH",
                "postal_code": "01234",
                "k_number": ["K1", "K2"],
                "openfda": {**openfda, "device_class": "f", "fei_number": ["9"],
                            "registration_number": ["r1", "r2"], "k_number": ["K1"]},
            },
            {"cfres_id": "2", "postal_code": "x" * 21},
        ],
        {"disclaimer": "d", "license": "l", "last_updated": "2024-04-01",
         "results": {"skip": 0, "limit": 2, "total": 2}},
    )
    put(
        "device-enforcement.json",
        [
            {"recall_number": "Z-1", "event_id": "12", "report_date": "20240101", "openfda": {}},
            {"recall_number": "Z-2", "event_id": "12.5"},
        ],
    )
    put(
        "device-classification.json",
        [{"device_name": "Infusion Pump", "product_code": "FRN", "medical_specialty_code": "HO",
          "submission_type_id": "1", "openfda": {"k_number": ["K1"]}}],
    )
    put(
        "510k.json",
        [
            {"k_number": "K1", "applicant": "ACME", "third_party_flag": "Y",
             "expedited_review_flag": "", "decision_date": "2020-01-02", "country_code": "US"},
            {"k_number": "K1", "applicant": "Again"},
            {"k_number": "K3", "country_code": "USA"},
            {"k_number": "K4", "third_party_flag": "maybe"},
        ],
    )
    put("device-pma.json", [{"pma_number": "P1", "trade_name": "Heart", "zip": "1" * 11},
                            {"pma_number": "P2", "openfda": openfda}])
    put("device-udi.json", [{"anything": 1}])
    put("notes.json", [{"anything": 1}])
    put("device-event-0003.zip.json", [{"mdr_report_key": "never"}])
    put("recall-guide.pdf.json", [{"cfres_id": "never"}])
