from datetime import datetime

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cauce.operators import cleaning, dedup
from cauce.operators.shape import metrics_frame, to_metrics, to_row
from cauce.sinks import observed
from helpers import landing, metrics, plan, rows

DATE = "2010-01-01T00:00:00.000"
DAY = datetime(2010, 1, 1)


def test_least_id_survives_and_null_keys_are_equal(spark):
    df = landing(
        spark,
        [
            (9, DATE, None, "A", "1", "B", 1.0),
            (3, DATE, None, "A", "1", "B", 1.0),
            (5, DATE, None, "A", "1", "B", 2.0),
        ],
    )
    assert sorted(r["id"] for r in dedup.deduplicate(df).collect()) == [3, 5]
    assert dedup.duplicate_count(df).first()[0] == 1


def test_dedup_sees_raw_values(spark):
    df = landing(
        spark,
        [
            (1, DATE, "05", "Meta", "1", "B", 1.0),
            (2, DATE, "05 ", "Meta", "1", "B", 1.0),
            (3, DATE, "05", "META", "1", "B", 1.0),
        ],
    )
    cleaned = rows(cleaning.clean(df))
    assert [r[0] for r in cleaned] == [1, 2, 3]
    assert len({r[1:] for r in cleaned}) == 1


def test_clean_values(spark):
    df = landing(
        spark,
        [
            (1, DATE, " 05 ", " nariño ", " 05001 ", "\tx ", 1.9),
            (2, DATE, None, None, None, None, None),
            (3, "", "05", "A", "1", "B", 1.0),
            (4, "garbage", "05", "A", "1", "B", 1.0),
            (5, None, "05", "A", "1", "B", 1.0),
            (6, DATE, "", " ", "", "", 1e30),
            (7, DATE, "07", "C", "7", "D", 3e9),
        ],
    )
    assert rows(cleaning.clean(df)) == [
        (1, DAY, "05", "NARIÑO", "05001", "\tX", 1),
        (2, DAY, "00", "DESCONOCIDO", "00000", "DESCONOCIDO", 0),
        (6, DAY, "", "", "", "", 0),
        (7, DAY, "07", "C", "7", "D", 3_000_000_000),
    ]
    blank = rows(cleaning.clean(df, blank_as_null=True).filter("id = 6"))
    assert blank == [(6, DAY, "00", "DESCONOCIDO", "00000", "DESCONOCIDO", 0)]
    audit = metrics(cleaning.clean_audit(df))
    assert audit["initial_rows"] == 7
    assert audit["removed_undated"] == 3
    assert (audit["undated_null"], audit["undated_unparsed"]) == (1, 2)
    assert audit["counts_out_of_range"] == 1
    assert audit["final_rows"] == 4
    assert audit["nulls_fecha_hecho"] == 1
    assert metrics(cleaning.clean_summary(df)) == {
        "initial_rows": 7,
        "final_rows": 4,
        "removed_rows": 3,
    }


def test_profile_counts_nulls_of_every_copy(spark):
    df = landing(
        spark,
        [
            (None, DATE, None, "A", "1", "B", 1.0),
            (2, DATE, None, "A", "1", "B", 1.0),
            (3, DATE, "1", "A", "1", "B", float("nan")),
        ],
    )
    found = metrics(cleaning.profile(df))
    assert found["nulls_id"] == 1
    assert found["nulls_cod_depto"] == 2
    assert found["nulls_cantidad"] == 1
    assert found["duplicate_rows"] == 1
    per_column = {r["column"]: r["nulls"] for r in cleaning.null_profile(df).collect()}
    assert per_column == {c: found[f"nulls_{c}"] for c in df.columns}


def test_no_rows(spark):
    df = landing(spark, [])
    assert rows(cleaning.clean(df)) == []
    assert set(metrics(cleaning.clean_audit(df)).values()) == {0}


def test_further_columns_are_kept_and_compared(spark):
    df = landing(spark, [(1, DATE, "1", "A", "1", "B", 1.0)] * 2).withColumn(
        "extra", F.monotonically_increasing_id()
    )
    cleaned = cleaning.clean(df)
    assert cleaned.columns[-1] == "extra"
    assert cleaned.count() == 2


def test_one_shuffle_and_the_date_test_below_it(spark, tmp_path):
    path = str(tmp_path / "landing")
    landing(spark, [(1, DATE, "1", "A", "1", "B", 1.0)]).write.parquet(path)
    df = spark.read.parquet(path)
    text = plan(cleaning.clean(df))
    assert text.count("Exchange hashpartitioning") == 1 and text.count("Exchange") == 1
    assert text.index("Exchange") < text.index("Filter (isnotnull(fecha_hecho")
    assert "PushedFilters: [IsNotNull(fecha_hecho)]" in text
    assert "SortAggregate" not in text
    audit = plan(cleaning.clean_audit(df))
    assert audit.count("Exchange hashpartitioning") == 1
    assert "SortAggregate" not in audit


def test_table_and_audit_share_one_shuffle(spark):
    """What the cleaning job writes: metrics are collected above the shuffle, in the last stage."""
    df = landing(spark, [(1, DATE, "1", "A", "1", "B", 1.0)])
    measures = {**cleaning.profile_measures(df), **cleaning.step_measures()}
    groups, _ = observed(cleaning.audited_groups(df), measures)
    text = plan(cleaning.clean_groups(groups, df.columns))
    assert text.count("Exchange hashpartitioning") == 1
    assert text.index("CollectMetrics") < text.index("Exchange")


def test_rows_and_metrics_turn_into_each_other(spark):
    values = {"a": 1, "b": 2}
    row = to_row(metrics_frame(spark, values), values)
    assert row.first().asDict() == values
    assert metrics(to_metrics(row)) == values


texts = st.sampled_from([None, "", " a", "a", "A", "b "])
records = st.lists(
    st.tuples(
        st.integers(1, 50),
        st.sampled_from([None, "", DATE, "2011-01-01T10:00:00.000", "bad"]),
        st.sampled_from([None, "", "05", " 5", "x"]),
        texts,
        texts,
        texts,
        st.sampled_from([None, 0.0, 1.0, 1.9, -2.5, 3e9]),
    ),
    max_size=25,
)


def brute_force(data):
    least = {}
    for number, *key in data:
        least[tuple(key)] = min(number, least.get(tuple(key), number))
    result = []
    for (date, code, name, town_code, town, count), number in least.items():
        try:
            parsed = datetime.fromisoformat(date)
        except (TypeError, ValueError):
            continue
        whole = 0 if count is None or abs(count) > 2**63 else int(count)
        result.append(
            (
                number,
                parsed,
                "00" if code is None else code.strip(" "),
                ("DESCONOCIDO" if name is None else name).strip(" ").upper(),
                "00000" if town_code is None else town_code.strip(" "),
                ("DESCONOCIDO" if town is None else town).strip(" ").upper(),
                whole,
            )
        )
    return sorted(result)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(records)
def test_clean_against_brute_force(spark, data):
    df = landing(spark, data)
    expected = brute_force(data)
    assert sorted(tuple(r) for r in cleaning.clean(df).collect()) == expected
    audit = metrics(cleaning.clean_audit(df))
    assert audit["initial_rows"] == len(data)
    assert audit["duplicate_rows"] == len(data) - len({r[1:] for r in data})
    assert audit["final_rows"] == len(expected)
