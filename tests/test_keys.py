import hashlib

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from salesmart.functions.keys import lookup_key, surrogate_key
from salesmart.operators.dense import dense_ids, with_dense_keys

SEP = chr(31)


def expected(values) -> int:
    parts = ["n" if v is None else "v" + v.replace(SEP, SEP * 2) for v in values]
    return int(hashlib.md5(SEP.join(parts).encode()).hexdigest()[:15], 16)


def keys_of(spark, tuples):
    frame = spark.createDataFrame(tuples, "a string, b string")
    return [r[0] for r in frame.select(surrogate_key(F.col("a"), F.col("b"))).collect()]


def test_key_is_the_md5_prefix(spark):
    tuples = [("x", "y"), (None, ""), ("", None), (None, None), ("ä", "я")]
    assert keys_of(spark, tuples) == [expected(t) for t in tuples]


def test_null_empty_and_shifted_values_differ(spark):
    tuples = [
        (None, None),
        ("", None),
        (None, ""),
        ("", ""),
        ("n", None),
        ("a" + SEP + "vb", "c"),
        ("a", "b" + SEP + "vc"),
        ("a" + SEP, "b"),
        ("a", SEP + "b"),
    ]
    assert len(set(keys_of(spark, tuples))) == len(tuples)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.tuples(
            st.one_of(st.none(), st.text("av n" + SEP, max_size=4)),
            st.one_of(st.none(), st.text("av n" + SEP, max_size=4)),
        ),
        min_size=1,
        max_size=60,
        unique=True,
    )
)
def test_different_tuples_get_different_keys(spark, tuples):
    keys = keys_of(spark, tuples)
    assert keys == [expected(t) for t in tuples]
    assert len(set(keys)) == len(tuples)


def test_lookup_key_of_null_is_null(spark):
    frame = spark.createDataFrame([(None,), ("x",)], "a string")
    assert [r[0] for r in frame.select(lookup_key(F.col("a"))).collect()] == [None, expected(["x"])]


def test_dense_ids_equal_a_global_row_number(spark):
    members = spark.range(5000).select(
        surrogate_key(F.col("id")).alias("id"), F.col("id").alias("number")
    )
    dense = dense_ids(members, bucket_bits=6)
    globally = members.withColumn("dense_id", F.row_number().over(Window.orderBy("id")))
    columns = ["dense_id", "id", "number"]
    assert sorted(dense.select(columns).collect()) == sorted(globally.select(columns).collect())


def test_dense_ids_do_not_depend_on_the_partitions(spark):
    members = spark.range(1000).select(surrogate_key(F.col("id")).alias("id"))
    results = [sorted(dense_ids(members.repartition(n)).collect()) for n in (1, 5)]
    assert results[0] == results[1]


def test_dense_ids_tell_colliding_keys_apart(spark):
    members = spark.createDataFrame([(7, "b"), (7, "a"), (1 << 59, "c")], "id bigint, name string")
    dense = dense_ids(members, tie_break=["name"])
    assert sorted(map(tuple, dense.collect())) == [(1, 7, "a"), (2, 7, "b"), (3, 1 << 59, "c")]


def test_dense_foreign_keys_keep_null_and_share_a_table(spark):
    days = spark.createDataFrame([(10, 1), (20, 2)], "id bigint, dense_id bigint")
    table = spark.createDataFrame(
        [(100, 10, 20), (101, None, 10)], "id bigint, start_id bigint, end_id bigint"
    )
    own = dense_ids(table.select("id")).select("id", "dense_id")
    result = with_dense_keys(table, {"start_id": days, "end_id": days}, own)
    assert sorted(map(tuple, result.collect())) == [(1, 1, 2), (2, None, 1)]


def test_a_dimension_with_more_collisions_than_can_be_listed_has_second_keys_as_a_whole(
    spark, flat, tmp_path, monkeypatch
):
    from itertools import count

    import salesmart.functions.keys as functions
    import salesmart.plans.collisions as collisions
    from salesmart.functions.keys import Keys
    from salesmart.plans.marts import MARTS
    from salesmart.plans.warehouse import Warehouse
    from salesmart.sources.base import from_flat

    monkeypatch.setattr(functions, "MOST_SECOND_KEYS", 6)
    monkeypatch.setattr(collisions, "MOST_SECOND_KEYS", 6)
    sales = flat(*({"id": i, "customer_age": i, "supplier_name": f"S{i % 3}"} for i in range(12)))
    rounds = count()

    def make(keys):
        return Warehouse(spark, from_flat(sales, keys=keys), f"{tmp_path}/{next(rounds)}")

    found = collisions.settled(make, Keys(bits=1))
    keys = found.source.keys
    assert "dim_customers" in keys.whole and len(keys.second) <= 6
    assert found.table("dim_customers").select("id").distinct().count() == 12
    assert MARTS["sales_by_customer"](found.table).count() == 12
    assert collisions.from_note(collisions.noted(keys)) == keys


def test_dimensions_are_written_before_their_keys_are_counted_and_counted_once(
    spark, flat, tmp_path, monkeypatch
):
    import salesmart.plans.collisions as collisions
    from salesmart.plans.warehouse import Warehouse
    from salesmart.schema import DIMENSIONS
    from salesmart.sources.base import from_flat

    sales = flat(*({"id": i, "customer_age": i} for i in range(3)))
    made, counted = [], []
    count_keys = collisions.dq_duplicate_keys

    def make(keys):
        made.append(Warehouse(spark, from_flat(sales, keys=keys), f"{tmp_path}/w"))
        return made[-1]

    def counting(read):
        # Written several at a time by ``store``, not one by one by those who count.
        counted.append({*DIMENSIONS} <= {*made[-1]._written})
        return count_keys(read)

    monkeypatch.setattr(collisions, "dq_duplicate_keys", counting)
    assert collisions.settled(make) is made[-1]
    assert counted == [True]

    def numbered(self, name):
        raise AssertionError(f"{name}: numbers are computed though no stored member differs")

    monkeypatch.setattr(Warehouse, "numbered", numbered)
    assert collisions.with_stored(made[-1], made[-1].table) == []
