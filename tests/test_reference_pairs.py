"""Pair cases of the reference test-suite, run through features -> pair -> rules."""

from tests.records import judge_pair

REPO = "d8cd16ba-bb74-4420-821e-083f2bac17c2"


def facts_of(row):
    return set(row["reasons"].split(",")) if row["reasons"] else set()


def test_simple(spark):
    base = dict(speciesKey="1", decimalLatitude=44.0, decimalLongitude=44.0, catalogNumber="TIM1", year=1978, month=12, day=21)
    row = judge_pair(spark, dict(base, gbifId="o1", datasetKey="1", occurrenceID="1"),
                     dict(base, gbifId="o2", datasetKey="2", occurrenceID="2"))
    assert row["related"] and "SAME_ACCEPTED_SPECIES" in facts_of(row)


def test_cortinarius(spark):
    common = dict(speciesKey="3348943", recordNumber="TEB 12-16", year=2016, month=6, day=11, eventDate="2016-06-11T00:00:00")
    o1 = dict(common, gbifId="o1", datasetKey="1", occurrenceID="urn:catalog:O:F:304835",
              decimalLatitude=60.3302, decimalLongitude=10.4647, catalogNumber="304835")
    o2 = dict(common, gbifId="o2", datasetKey="2", occurrenceID="urn:uuid:152ce614-69e1-4fbe-8f1c-3340d0a15491",
              decimalLatitude=60.330181, decimalLongitude=10.464743, catalogNumber="O-DFL-6644/2-D")
    row = judge_pair(spark, o1, o2)
    assert row["related"] and "SAME_ACCEPTED_SPECIES" in facts_of(row)


def test_holotype_short_circuit(spark):
    o1 = dict(gbifId="o1", datasetKey="1", taxonKey="3350984", decimalLatitude=10.0, decimalLongitude=10.0,
              countryCode="DK", typeStatus=["HoloType"])
    o2 = dict(gbifId="o2", datasetKey="2", taxonKey="3350984", decimalLatitude=20.0, decimalLongitude=20.0,
              countryCode="NO", typeStatus=["HOLOTYPE", "NonsenseType"])
    row = judge_pair(spark, o1, o2)
    assert row["related"] and row["SAME_SPECIMEN"] and row["DIFFERENT_COUNTRY"]


def test_day_apart(spark):
    common = dict(speciesKey="1850114", year=2004, month=8, countryCode="DK", recordedBy=["Donald Hobern"])
    o1 = dict(common, gbifId="1227719129", datasetKey="2", decimalLatitude=55.736932, decimalLongitude=12.538104, day=2)
    o2 = dict(common, gbifId="49635968", datasetKey="1", decimalLatitude=55.737, decimalLongitude=12.538, day=1)
    row = judge_pair(spark, o1, o2)
    assert row["related"]
    assert {"APPROXIMATE_DATE", "WITHIN_200m", "SAME_COUNTRY", "SAME_RECORDER_NAME"} <= facts_of(row)


def test_three_decimals(spark):
    common = dict(speciesKey="3794925", year=2007, month=5, day=26)
    o1 = dict(common, gbifId="1675790844", datasetKey="1", decimalLatitude=21.8656, decimalLongitude=-102.909,
              recordedBy=["D. S. Seigler", "J. T. Miller"])
    o2 = dict(common, gbifId="2268858676", datasetKey="2", decimalLatitude=21.86558, decimalLongitude=-102.90929,
              recordedBy=["Robertson"])
    row = judge_pair(spark, o1, o2)
    assert row["related"] and {"SAME_DATE", "WITHIN_200m", "SAME_ACCEPTED_SPECIES"} <= facts_of(row)
    assert not row["SAME_RECORDER_NAME"]
    row = judge_pair(spark, o1, dict(o2, recordedBy=["Seigler", "J. T. Miller"]))
    assert row["SAME_RECORDER_NAME"]


def test_materialised_triplet(spark):
    o1 = dict(gbifId="1", datasetKey="1", speciesKey="1", institutionCode="A", collectionCode="B", catalogNumber="C",
              decimalLatitude=1.0, decimalLongitude=1.0)
    o2 = dict(gbifId="2", datasetKey="2", speciesKey="1", eventDate="20210101", decimalLatitude=1.0,
              decimalLongitude=1.0, catalogNumber="A:B:C")
    row = judge_pair(spark, o1, o2)
    assert row["related"] and row["IDENTIFIERS_OVERLAP"] and row["NON_CONFLICTING_DATE"]


def test_materialised_scoped(spark):
    o1 = dict(gbifId="1", datasetKey="1", speciesKey="1", institutionCode="A", collectionCode="B", catalogNumber="C",
              year=2000, month=1, day=1)
    o2 = dict(gbifId="2", datasetKey="2", speciesKey="1", catalogNumber="A:C", year=2000, month=1, day=1)
    row = judge_pair(spark, o1, o2)
    assert row["related"] and row["IDENTIFIERS_OVERLAP"]


def test_array_values(spark):
    o1 = dict(gbifId="1", datasetKey="1", speciesKey="1", eventDate="A", recordedBy=["John", "tim"],
              otherCatalogNumbers=["cat1"])
    o2 = dict(gbifId="2", datasetKey="2", speciesKey="1", eventDate="A", catalogNumber="C-AT-1", recordedBy=["TIM"])
    row = judge_pair(spark, o1, o2)
    assert row["related"] and {"SAME_RECORDER_NAME", "IDENTIFIERS_OVERLAP"} <= facts_of(row)


def test_sparse_needs_sequence_repository(spark):
    o1 = dict(gbifId="1", datasetKey="1", speciesKey="212", catalogNumber="ABC")
    o2 = dict(gbifId="2", datasetKey="2", speciesKey="212", catalogNumber="ABC")
    assert not judge_pair(spark, o1, o2)["related"]
    row = judge_pair(spark, o1, dict(o2, datasetKey=REPO.upper()))
    assert row["related"] and {"SAME_ACCEPTED_SPECIES", "IDENTIFIERS_OVERLAP"} <= facts_of(row)


def test_other_catalog_numbers_rule_needs_specimens(spark):
    o1 = dict(gbifId="1", datasetKey="1", institutionCode="KU", collectionCode="MAMM", catalogNumber="X123",
              basisOfRecord="PRESERVED_SPECIMEN", countryCode="DK")
    o2 = dict(gbifId="2", datasetKey="2", otherCatalogNumbers=["KU:MAMM:X123"], basisOfRecord="PRESERVED_SPECIMEN")
    row = judge_pair(spark, o1, o2)
    assert row["OTHER_CATALOG_NUMBERS_OVERLAP"] and row["related"]
    row = judge_pair(spark, o1, dict(o2, basisOfRecord="MATERIAL_SAMPLE"))
    assert row["OTHER_CATALOG_NUMBERS_OVERLAP"] and not row["related"]


def test_veto_and_reason_order(spark):
    common = dict(speciesKey="5", decimalLatitude=1.0, decimalLongitude=1.0, year=2000, month=1, day=1)
    row = judge_pair(spark, dict(common, countryCode="DK"), dict(common, countryCode="NO"))
    assert row["DIFFERENT_COUNTRY"] and not row["related"]
    row = judge_pair(spark, dict(common, countryCode="DK"), dict(common))
    assert row["reasons"] == "SAME_ACCEPTED_SPECIES,SAME_DATE,SAME_COORDINATES,NON_CONFLICTING_COUNTRY"
    assert row["related"]


def test_coordinates_one_sided_on_different_records(spark):
    row = judge_pair(spark, dict(decimalLatitude=1.0), dict(decimalLongitude=2.0))
    assert row["NON_CONFLICTING_COORDINATES"]
    row = judge_pair(spark, dict(decimalLatitude=1.0, decimalLongitude=1.0), dict(decimalLatitude=1.0))
    assert not row["NON_CONFLICTING_COORDINATES"] and not row["WITHIN_2Km"]


def test_dates_month_apart_count_as_approximate(spark):
    row = judge_pair(spark, dict(year=2000, month=1, day=15), dict(year=2000, month=2, day=16))
    assert row["APPROXIMATE_DATE"]
    row = judge_pair(spark, dict(year=2000, month=1, day=15), dict(year=2000, month=2, day=16), strict_days=True)
    assert not row["APPROXIMATE_DATE"]
    row = judge_pair(spark, dict(year=2000, month=2, day=30), dict(year=2000, month=2, day=29))
    assert not row["APPROXIMATE_DATE"] and not row["SAME_DATE"]
