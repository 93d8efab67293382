from palimpsest.llm import membership


def test_rows_without_a_partner_are_told_apart(spark):
    frame = spark.createDataFrame([(at if at % 10 else None, at, 1) for at in range(3000)], "id long, at long, __x int")
    ids = spark.createDataFrame([(at,) for at in range(0, 3000, 3)] + [(None,), (-5,)], "key long")
    may, rest = membership.divide(frame, "id", ids)
    assert may.columns == rest.columns == frame.columns
    found, left = ({row.at for row in side.collect()} for side in (may, rest))
    assert found | left == set(range(3000)) and not found & left
    wanted = {at for at in range(3000) if at % 3 == 0 and at % 10}
    assert wanted <= found and len(found - wanted) < 5
    assert membership.bitmap(ids).count() <= membership.BITS >> membership.ROW


def test_without_ids_or_rows(spark):
    frame = spark.createDataFrame([(1,), (None,)], "id int")
    may, rest = membership.divide(frame, "id", spark.createDataFrame([], "key long"))
    assert (may.count(), rest.count()) == (0, 2)
    may, rest = membership.divide(frame.limit(0), "id", spark.createDataFrame([(1,)], "key long"))
    assert (may.count(), rest.count()) == (0, 0)
