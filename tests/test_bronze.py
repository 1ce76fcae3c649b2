import hashlib
import json

import pytest
from conftest import CONDITION, CONSENT, HEALTH_ID, LOADED, PATIENT, bundle_of

from clinlake.operators import bronze
from clinlake.sources import files


def resources(df):
    return [(r.resource_type, r.fhir_resource_id) for r in bronze.build_bronze(df).collect()]


def test_resources_of_a_bundle(bundles):
    rows = bronze.build_bronze(bundles(bundle_of(PATIENT, CONDITION))).collect()
    assert {(r.resource_type, r.fhir_resource_id) for r in rows} == {("Patient", "p-31"), ("Condition", "c-9")}
    assert {r.resource_type: json.loads(r.resource_json) for r in rows} == {"Patient": PATIENT, "Condition": CONDITION}


def test_resource_json_is_compact(bundles):
    small = {"resourceType": "Basic", "id": "b", "n": [1, 2.5], "o": {"a": None, "u": "é"}}
    row = bronze.build_bronze(bundles(json.dumps(json.loads(bundle_of(small)), indent=4))).first()
    assert row.resource_json == '{"resourceType":"Basic","id":"b","n":[1,2.5],"o":{"a":null,"u":"é"}}'


@pytest.mark.parametrize(
    "text",
    [
        None, "", "   ", "{not valid", "[]", "7", "null", '"x"',
        json.dumps([{"resourceType": "Practitioner", "id": "p"}]),
        '{"resourceType":"Bundle"}', '{"entry":[]}', '{"entry":null}', '{"entry":7}', '{"entry":{"resource":{}}}',
        '{"entry":[{"fullUrl":"u"}]}', '{"entry":[{"resource":null}]}', '{"entry":[{"resource":{}}]}',
        '{"entry":[{"resource":{"id":"r"}}]}', '{"entry":[{"resource":{"resourceType":null,"id":"r"}}]}',
        '{"entry":[{"resource":{"resourceType":"","id":"r"}}]}', '{"entry":[{"resource":"text"}]}',
        # cut off after a complete entry list, or followed by something
        '{"entry":[{"resource":{"resourceType":"Patient","id":"p"}}],"total":',
        '{"entry":[{"resource":{"resourceType":"Patient","id":"p"}}]} more',
        '{"entry":[{"resource":{"resourceType":"Patient","id":"p"}}]},{"entry":[]}',
        "{'entry':[{'resource':{'resourceType':'Patient','id':'p'}}]}",
    ],
)
def test_texts_without_resources(bundles, text):
    assert resources(bundles(text)) == []


def test_mixed_entries_keep_the_valid_ones(bundles):
    text = json.dumps(
        {"entry": [{"resource": PATIENT}, {"fullUrl": "u"}, {"resource": {"id": "r"}}, {"resource": CONDITION}]}
    )
    assert resources(bundles(text)) == [("Patient", "p-31"), ("Condition", "c-9")]


def test_entry_that_is_no_object_does_not_void_the_bundle(bundles):
    text = json.dumps({"entry": [5, None, "x", [], {"resource": PATIENT}]})
    df = bundles(text, bundle_of(CONDITION))
    assert sorted(resources(df)) == [("Condition", "c-9"), ("Patient", "p-31")]


def test_resource_without_id_is_kept_and_named_by_its_hash(bundles):
    a, b = {"resourceType": "Basic", "x": 1}, {"resourceType": "Basic", "x": 2}
    rows = bronze.build_bronze(bundles(bundle_of(a, b))).collect()
    assert [r.fhir_resource_id for r in rows] == [None, None]
    assert len({r._lineage_id for r in rows}) == 2


def test_lineage_id_and_content_hash(bundles):
    text = bundle_of(PATIENT)
    row = bronze.build_bronze(bundles(text)).first()
    assert row._lineage_id == hashlib.sha256(b"file-0.json|p-31").hexdigest()
    assert row._content_hash == hashlib.sha256(text.encode()).hexdigest()
    assert row._loaded_at == LOADED


def test_lineage_id_differs_by_file_and_resource(bundles):
    rows = bronze.build_bronze(bundles(bundle_of(PATIENT, CONDITION), bundle_of(PATIENT))).collect()
    assert len({r._lineage_id for r in rows}) == 3


def test_quarantine_names_the_reason(bundles):
    df = bundles(None, " ", "{cut", '{"a":1} x', "[1]", "null", '{"a":1}', bundle_of(PATIENT))
    got = {r._source_file: r.reason for r in bronze.quarantine(df).collect()}
    assert got == {
        "file-0.json": "empty file", "file-1.json": "empty file", "file-2.json": "not valid JSON",
        "file-3.json": "not valid JSON", "file-4.json": "not valid JSON", "file-5.json": "not an object",
        "file-6.json": "no entry list",
    }


def test_skipped_entries_are_counted(bundles):
    df = bundles(json.dumps({"entry": [5, {"resource": {"id": "r"}}, {"resource": PATIENT}]}), bundle_of(PATIENT))
    assert [(r._source_file, r.skipped) for r in bronze.skipped_entries(df).collect()] == [("file-0.json", 2)]


def test_route(bundles):
    landed = bronze.build_bronze(bundles(bundle_of(PATIENT, CONDITION, CONSENT)))
    assert [r.fhir_resource_id for r in bronze.route(landed, "Consent").collect()] == ["k-1"]


def test_new_files_by_path_and_content(bundles):
    landed = bronze.build_bronze(bundles(bundle_of(PATIENT), bundle_of(CONDITION)))
    later = bundles(bundle_of(PATIENT), bundle_of(CONSENT), bundle_of(CONDITION))
    assert sorted(r._source_file for r in bronze.new_files(later, landed).collect()) == ["file-1.json", "file-2.json"]


def test_identifiers_exploded(raw):
    rows = bronze.identifiers_exploded(raw(PATIENT, {"resourceType": "Patient", "id": "none"})).collect()
    assert {(r.fhir_patient_id, r.system, r.value) for r in rows} == {
        ("p-31", "https://healthid.ndhm.gov.in", HEALTH_ID),
        ("p-31", "urn:example:ward-list", "W/204"),
        ("p-31", "urn:example:other", "second"),
    }


def test_scan_reads_a_pretty_printed_file_as_one_row(spark, tmp_path):
    folder = tmp_path / "in" / "deep"
    folder.mkdir(parents=True)
    text = json.dumps(json.loads(bundle_of(PATIENT)), indent=2)
    (folder / "a.json").write_text(text)
    (tmp_path / "in" / "b.json").write_text(bundle_of(CONDITION))
    (tmp_path / "in" / "notes.md").write_text("x")
    rows = files.scan_bundles(spark, str(tmp_path / "in"), glob="*.json").collect()
    assert len(rows) == 2
    by_name = {r._source_file.rsplit("/", 1)[1]: r for r in rows}
    assert by_name["a.json"].bundle_json == text
    assert by_name["a.json"]._content_hash == hashlib.sha256(text.encode()).hexdigest()
    assert by_name["a.json"]._loaded_at is not None
