"""New entities and contacts of a source."""

from entitymill.operators import inserts

RECORD = "record_id long, company_name string, name_key string, state string"


def test_new_entities_are_numbered_behind_the_highest(spark):
    rows = [(9, "Acme LLC", "acme", "TX"), (4, "ACME", "acme", "TX"), (7, "Acme", "acme", "CA"), (5, "Acme", "acme", None),
            (2_000_000, "Acme Inc", "acme", None), (3_000_000, "Zed", "zed", "TX"), (6, None, None, "TX")]
    known = spark.createDataFrame([(20,), (3,)], "entity_id long")
    for parts in (1, 5):  # the same ids however the rows lie
        frame = spark.createDataFrame(rows, RECORD).repartition(parts)
        inserted, placed = inserts.new_entities(frame, known)
        assert sorted(map(tuple, inserted.collect())) == [
            (21, "ACME", "acme", "TX", 4, 2), (22, "Acme", "acme", None, 5, 2), (23, "Acme", "acme", "CA", 7, 1),
            (24, "Zed", "zed", "TX", 3_000_000, 1)]
        assert sorted(map(tuple, placed.collect())) == [
            (4, 21), (5, 22), (7, 23), (9, 21), (2_000_000, 22), (3_000_000, 24)]


def test_no_new_entities(spark):
    none = spark.createDataFrame([], RECORD)
    inserted, placed = inserts.new_entities(none, spark.createDataFrame([], "entity_id long"))
    assert inserted.count() == placed.count() == 0
    inserted, _ = inserts.new_entities(
        spark.createDataFrame([(1, "A", "a", "TX")], RECORD), spark.createDataFrame([], "entity_id long"))
    assert [r.entity_id for r in inserted.collect()] == [1]


def test_new_contacts_do_not_repeat(spark):
    matched = spark.createDataFrame(
        [(1, 7, "Pat", "p@x.com", 80), (2, 7, "Patrick", "p@x.com", 75), (3, 7, "Sam", None, 80), (4, 7, "Sam", None, 75),
         (5, 7, "Lee", "held@x.com", 80), (6, 8, "Lee", "held@x.com", 80), (7, 8, None, "q@x.com", 80), (8, 8, "Kim", None, 80)],
        "record_id long, entity_id long, contact_name string, email string, confidence int")
    held = spark.createDataFrame([(7, "L", "held@x.com"), (8, "Kim", None)], "entity_id long, contact_name string, email string")
    assert sorted(map(tuple, inserts.new_contacts(matched, held).collect()), key=lambda r: r[-1]) == [
        (7, "Pat", "p@x.com", 80, 1), (7, "Sam", None, 80, 3), (8, "Lee", "held@x.com", 80, 6)]
