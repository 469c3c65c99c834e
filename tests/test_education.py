import pytest
from pyspark.sql import functions as F

from strata.plans import education
from strata.sinks import snapshot

from support import rows

SCHOOLS = [("s1", "North", "D", "CA", "public", "K-6", "40"), ("s2", "South", "D", "NY", "charter", "K-6", "x"),
           ("s3", "Empty", "D", "TX", "private", "K-6", None)]
EDUCATORS = [(f"e{i}", f"F{i}", "L", "m", "lead_teacher", "c", s, "2020-01-01", "active")
             for i, s in enumerate(["s1", "s1", "s1", "s2", "s3"])]
ROOMS = [("r1", "A", "K", "s1", "e0", "20", "general"), ("r2", "B", "1", "s1", "e0", "20", "general"),
         ("r3", "C", "2", "s2", "e3", "20", "general"), ("r4", "D", "2", "s2", "e3", "20", "STEM")]
PUPILS = [(f"p{i}", "F", "L", "2015-02-30" if i == 0 else "2015-02-01", "K", s, r, "2020-09-01", "active")
          for i, (s, r) in enumerate([("s1", "r1"), ("s1", "r1"), ("s1", "r2"), ("s2", "r3"),
                                      ("s2", "r3")])]
TESTS = [(f"a{i}", f"p{p}", "e1", subject, "d", score, "2024-02-01", "winter", "o1", "")
         for i, (p, subject, score) in enumerate([
             (0, "math", "1.5"), (0, "math", "2.5"), (1, "math", "4.0"), (1, "art", "9.0"),
             (2, "math", "x"), (2, "math", "3.0"), (3, "math", "7.25")])]
GOALS = [("o1", "math", "d", "t", "K", "MAT.1.1")]


@pytest.fixture
def tables(spark):
    data = {"schools": SCHOOLS, "educators": EDUCATORS, "classrooms": ROOMS, "students": PUPILS,
            "assessments": TESTS, "learning_objectives": GOALS}
    made = {}
    for name, entity in education.ENTITIES.items():
        columns = ", ".join(f"{c} STRING" for c in entity.schema.names)
        again = data[name][:1] + [(None, *data[name][0][1:])]  # a repeat and a missing key
        made[name] = spark.createDataFrame(data[name] + again, columns)
    return made


def test_silver_casts_and_removes(tables):
    clean = {n: education.silver(n, df) for n, df in tables.items()}
    assert {n: df.count() for n, df in clean.items()} == {
        "schools": 3, "educators": 5, "classrooms": 4, "students": 5, "assessments": 7,
        "learning_objectives": 1}
    assert dict(clean["assessments"].dtypes)["score"] == "double"
    assert dict(clean["students"].dtypes)["date_of_birth"] == "date"
    assert rows(clean["schools"].select("school_id", "student_capacity")) == [
        ("s1", 40), ("s2", None), ("s3", None)]
    assert clean["students"].filter("student_id = 'p0'").first().date_of_birth is None


def test_gold_tables(tables):
    out = education.build(tables)
    summary = rows(out["assessment_summary_by_classroom"].drop("classroom_name", "grade_level",
                                                               "school_name"))
    assert summary == [
        ("r1", "s1", "art", "winter", 1, 9.0, 9.0, 9.0, None),
        ("r1", "s1", "math", "winter", 2, 2.67, 1.5, 4.0, 1.26),
        ("r2", "s1", "math", "winter", 1, 3.0, 3.0, 3.0, None),
        ("r3", "s2", "math", "winter", 1, 7.25, 7.25, 7.25, None)]
    assert rows(out["educator_performance_metrics"]) == [
        ("e0", "F0", "L", "lead_teacher", "North", 3, 6, 4.0, 2),
        ("e3", "F3", "L", "lead_teacher", "South", 1, 1, 7.25, 1)]
    overview = out["school_performance_overview"].drop("name", "district", "state", "school_type")
    assert rows(overview) == [("s1", 3, 3, 2, 4.0, 6), ("s2", 2, 1, 2, 7.25, 1),
                              ("s3", 0, 1, 0, None, 0)]
    for name, keys in snapshot.SERVED_KEYS.items():
        assert tuple(snapshot.key_violations(out[name], keys).first())[1:] == (0, 0)


def test_adding_up_equals_the_plain_joins(tables):
    """The rewritten educator and school tables against joins that multiply rows."""
    out = education.build(tables)
    c = {n: out[f"silver_{n}"].alias(n) for n in tables}

    def on(a, b, key):
        return F.col(f"{a}.{key}") == F.col(f"{b}.{key}")

    fan = (c["schools"].join(c["classrooms"], on("schools", "classrooms", "school_id"), "left")
           .join(c["students"], on("students", "schools", "school_id"), "left")
           .join(c["educators"], on("educators", "schools", "school_id"), "left")
           .join(c["assessments"], on("assessments", "students", "student_id"), "left"))
    plain = fan.groupBy("schools.school_id").agg(
        F.count_distinct("students.student_id"), F.count_distinct("educators.educator_id"),
        F.count_distinct("classrooms.classroom_id"), F.round(F.avg("assessments.score"), 2),
        F.count_distinct("assessments.assessment_id"))
    ours = out["school_performance_overview"].drop("name", "district", "state", "school_type")
    assert rows(ours) == rows(plain)

    chain = (c["educators"].join(c["classrooms"], on("educators", "classrooms", "educator_id"))
             .join(c["students"], on("students", "classrooms", "classroom_id"))
             .join(c["assessments"], on("assessments", "students", "student_id")))
    plain = chain.groupBy("educators.educator_id").agg(
        F.count_distinct("students.student_id"), F.count_distinct("assessments.assessment_id"),
        F.round(F.avg("assessments.score"), 2), F.count_distinct("classrooms.classroom_id"))
    ours = out["educator_performance_metrics"].select(
        "educator_id", "student_count", "assessment_count", "avg_student_score", "classroom_count")
    assert rows(ours) == rows(plain)


def test_assessments_move_once(spark, tables, path):
    """The distinct count of students needs no exchange of its own above the join."""
    stored = {}
    for name, df in tables.items():
        education.silver(name, df).write.parquet(path(name))
        stored[name] = spark.read.parquet(path(name))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = education.assessment_summary(
            stored["schools"], stored["classrooms"], stored["students"],
            stored["assessments"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning(student_id") == 2
    assert not any("student_id" in line and "subject" in line
                   for line in plan.splitlines() if "Exchange" in line)


