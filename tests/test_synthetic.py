import pytest
from pyspark.sql import functions as F

from strata import schemas
from strata.plans import education
from strata.sinks.lake import Lake
from strata.sinks import snapshot
from strata.sinks.snapshot import SERVED_KEYS
from strata.sources import synthetic as s

from support import rows

DAY, SIZES = "2024-01-31", {"schools": 50, "educators": 200, "classrooms": 150,
                            "students": 1500, "objectives": 100, "assessments": 5000}


@pytest.fixture(scope="module")
def made(spark):
    n = SIZES
    return {
        "schools": s.schools(s.ids(spark, n["schools"])),
        "educators": s.educators(s.ids(spark, n["educators"]), n["schools"], DAY),
        "classrooms": s.classrooms(s.ids(spark, n["classrooms"]), n["schools"], n["educators"]),
        "students": s.students(s.ids(spark, n["students"]), n["schools"], n["classrooms"], DAY),
        "learning_objectives": s.learning_objectives(s.ids(spark, n["objectives"])),
        "assessments": s.assessments(s.ids(spark, n["assessments"]), n["students"],
                                     n["educators"], n["objectives"], DAY),
    }


def test_shapes_follow_the_entities(made):
    for name, df in made.items():
        assert df.schema.simpleString() == education.ENTITIES[name].schema.simpleString(), name
        key = education.ENTITIES[name].key
        assert df.select(key).distinct().count() == df.count()


def test_relations_hold(made):
    people, rooms, pupils = made["educators"], made["classrooms"], made["students"]
    lead = people.filter("role = 'lead_teacher'")
    assert rooms.join(lead, "educator_id", "left_anti").count() == 0
    same = pupils.join(rooms, ["classroom_id", "school_id", "grade_level"], "left_anti")
    assert same.count() == 0
    for child, parent, key in (("educators", "schools", "school_id"),
                               ("classrooms", "schools", "school_id"),
                               ("assessments", "students", "student_id"),
                               ("assessments", "educators", "educator_id")):
        assert made[child].join(made[parent], key, "left_anti").count() == 0
    goals = made["learning_objectives"].withColumnRenamed("objective_id", "learning_objective_id")
    assert made["assessments"].join(goals, ["learning_objective_id", "subject", "domain"],
                                    "left_anti").count() == 0


def test_values_stay_in_range(made):
    a = made["assessments"]
    assert a.filter("score < 1 OR score > 9 OR score <> round(score, 1)").count() == 0
    share = made["students"].filter("status = 'active'").count() / SIZES["students"]
    assert 0.8 < share < 0.9
    assert made["learning_objectives"].filter(
        ~F.col("standard_code").rlike("^[A-Z]{3}\\.[1-9]\\.[1-9]$")).count() == 0


def test_rows_do_not_depend_on_partitions(spark):
    one = s.orders(s.ids(spark, 500).repartition(1), "2024-01-31 00:00:00")
    many = s.orders(s.ids(spark, 500).repartition(9), "2024-01-31 00:00:00")
    assert one.schema.simpleString() == schemas.ORDERS.simpleString()
    assert rows(one) == rows(many)


def test_gold_builds_from_invented_rows(made):
    out = education.build({n: df for n, df in made.items()})
    overview = out["school_performance_overview"]
    assert overview.count() == 50
    totals = overview.agg(F.sum("total_students"), F.sum("total_educators"),
                          F.sum("total_classrooms"), F.sum("total_assessments")).first()
    assert tuple(totals) == (1500, 200, 150, 5000)


def test_messages_names_emails(spark):
    made = s.messages(s.ids(spark, 300), "2024-01-31 00:00:00")
    assert made.schema.simpleString() == schemas.MESSAGE.simpleString()
    assert made.select("client_id").distinct().count() == 5
    assert s.names(s.ids(spark, 300)).schema.simpleString() == schemas.NAME_ROW.simpleString()
    mails = s.masked_emails(s.ids(spark, 20), DAY)
    assert mails.schema.simpleString() == schemas.MASKED_EMAIL.simpleString()
    values = spark.range(200).select(s.value_of(F.col("id")).alias("v"))
    assert values.filter("v < 0 OR v >= 100").count() == 0


def test_from_csv_files_to_served_copies(spark, made, path):
    for name, df in made.items():
        df.write.option("header", True).csv(f"{path('csv')}/{name}.csv")
    lake = Lake(spark, path("lake"))
    out = education.run(lake, path("csv"))
    assert set(out) == set(SERVED_KEYS)
    direct = education.gold({n: education.silver(n, df) for n, df in made.items()})
    for name in out:
        assert rows(out[name]) == rows(direct[name])
    education.serve(lake, path("served"))
    served = snapshot.serving(spark, f"{path('served')}/school_performance_overview")
    assert rows(served) == rows(out["school_performance_overview"])
