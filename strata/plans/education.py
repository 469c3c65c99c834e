"""Education roll-ups: six entities cleaned, three gold tables.

The gold functions expect silver tables, in which each entity's key is unique. They rely on
that to count rows where a distinct count would need one more shuffle."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata import schemas
from strata.operators import conform, dedup, quality
from strata.sinks import snapshot
from strata.sinks.lake import Lake
from strata.sources import files


@dataclass(frozen=True)
class Entity:
    key: str
    schema: StructType
    casts: dict[str, str] = field(default_factory=dict)


ENTITIES = {
    "schools": Entity("school_id", schemas.SCHOOLS, {"student_capacity": "int"}),
    "educators": Entity("educator_id", schemas.EDUCATORS, {"hire_date": "date"}),
    "classrooms": Entity("classroom_id", schemas.CLASSROOMS, {"capacity": "int"}),
    "students": Entity("student_id", schemas.STUDENTS,
                       {"date_of_birth": "date", "enrollment_date": "date"}),
    "assessments": Entity("assessment_id", schemas.ASSESSMENTS,
                          {"score": "double", "assessment_date": "date"}),
    "learning_objectives": Entity("objective_id", schemas.LEARNING_OBJECTIVES),
}


def bronze(spark: SparkSession, root: str, entity: str) -> DataFrame:
    """The entity's CSV files. Columns that silver casts are read as text, so that a bad
    value becomes NULL there and does not spoil its row here."""
    spec = ENTITIES[entity]
    text = StructType()
    for f in spec.schema.fields:
        text.add(f.name, "string" if f.name in spec.casts else f.dataType)
    return files.read_csv(spark, f"{root.rstrip('/')}/{entity}.csv", text)


def silver(entity: str, rows: DataFrame) -> DataFrame:
    """Typed rows with a key, each key once."""
    spec = ENTITIES[entity]
    keyed = quality.enforce(rows, [quality.not_null(spec.key)])
    typed = conform.typed(keyed, **{c: t for c, t in spec.casts.items() if c in rows.columns})
    return (dedup.first_per_key(typed, [spec.key])
            .withColumn("_processed_at", F.current_timestamp()))


def assessment_summary(schools: DataFrame, classrooms: DataFrame, students: DataFrame,
                       assessments: DataFrame) -> DataFrame:
    """Scores per classroom, subject and period.

    Assessments are shuffled once, by student; the distinct count of students reuses that
    layout. Names are looked up for the finished groups, not carried through the shuffle."""
    scores = assessments.select("student_id", "subject", "assessment_period", "score")
    grouped = (
        scores.join(students.select("student_id", "classroom_id"), "student_id")
        .groupBy("classroom_id", "subject", "assessment_period")
        .agg(
            F.count_distinct("student_id").alias("student_count"),
            F.round(F.avg("score"), 2).alias("avg_score"),
            F.min("score").alias("min_score"),
            F.max("score").alias("max_score"),
            F.round(F.stddev("score"), 2).alias("stddev_score"),
        )
    )
    rooms = classrooms.select("classroom_id", F.col("name").alias("classroom_name"),
                              "grade_level", "school_id")
    names = schools.select("school_id", F.col("name").alias("school_name"))
    return grouped.join(rooms.join(names, "school_id"), "classroom_id").select(
        "classroom_id", "classroom_name", "grade_level", "school_id", "school_name", "subject",
        "assessment_period", "student_count", "avg_score", "min_score", "max_score",
        "stddev_score",
    )


def _per_student(assessments: DataFrame) -> DataFrame:
    """Additive figures of each student's assessments; collapses a busy student before any
    join sees the rows."""
    return assessments.groupBy("student_id").agg(
        F.count("assessment_id").alias("taken"),
        F.count("score").alias("scored"),
        F.sum("score").alias("points"),
    )


def _mean_points() -> F.Column:
    return F.round(F.try_divide(F.sum("points"), F.sum("scored")), 2)


def educator_metrics(schools: DataFrame, educators: DataFrame, classrooms: DataFrame,
                     students: DataFrame, assessments: DataFrame) -> DataFrame:
    """Assessed students, their assessments and mean score, and classrooms per educator.

    Each step adds up the one below (student, classroom, educator), so that no join repeats
    rows and no distinct count is needed."""
    per_student = _per_student(assessments).join(
        students.select("student_id", "classroom_id"), "student_id")
    per_room = per_student.groupBy("classroom_id").agg(
        F.count(F.lit(1)).alias("pupils"), F.sum("taken").alias("taken"),
        F.sum("scored").alias("scored"), F.sum("points").alias("points"))
    per_educator = (
        per_room.join(classrooms.select("classroom_id", "educator_id"), "classroom_id")
        .groupBy("educator_id")
        .agg(
            F.sum("pupils").alias("student_count"),
            F.sum("taken").alias("assessment_count"),
            _mean_points().alias("avg_student_score"),
            F.count(F.lit(1)).alias("classroom_count"),
        )
    )
    names = schools.select("school_id", F.col("name").alias("school_name"))
    people = educators.select("educator_id", "first_name", "last_name", "role", "school_id")
    return per_educator.join(people.join(names, "school_id"), "educator_id").select(
        "educator_id", "first_name", "last_name", "role", "school_name", "student_count",
        "assessment_count", "avg_student_score", "classroom_count",
    )


def school_overview(schools: DataFrame, educators: DataFrame, classrooms: DataFrame,
                    students: DataFrame, assessments: DataFrame) -> DataFrame:
    """Totals and mean score per school, schools without pupils included.

    Classrooms, educators and assessments meet only at the school; joining them row by row
    would multiply them with each other. Every branch is therefore summed per school first,
    which gives the same totals and the same mean."""
    def size(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("school_id").agg(F.count(F.lit(1)).alias(name))

    pupils = (
        students.select("student_id", "school_id")
        .join(_per_student(assessments), "student_id", "left")
        .groupBy("school_id")
        .agg(F.count(F.lit(1)).alias("total_students"),
             _mean_points().alias("avg_assessment_score"),
             F.sum("taken").alias("total_assessments"))
    )
    joined = (
        schools.select("school_id", "name", "district", "state", "school_type")
        .join(pupils, "school_id", "left")
        .join(size(educators, "total_educators"), "school_id", "left")
        .join(size(classrooms, "total_classrooms"), "school_id", "left")
    )
    totals = ["total_students", "total_educators", "total_classrooms", "total_assessments"]
    return joined.na.fill(0, totals).select(
        "school_id", "name", "district", "state", "school_type", "total_students",
        "total_educators", "total_classrooms", "avg_assessment_score", "total_assessments",
    )


def gold(clean: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The three gold tables from the silver ones."""
    s, e, c = clean["schools"], clean["educators"], clean["classrooms"]
    p, a = clean["students"], clean["assessments"]
    return {
        "assessment_summary_by_classroom": assessment_summary(s, c, p, a),
        "educator_performance_metrics": educator_metrics(s, e, c, p, a),
        "school_performance_overview": school_overview(s, e, c, p, a),
    }


def build(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All silver and gold tables from the bronze ones, not yet computed."""
    clean = {name: silver(name, rows) for name, rows in tables.items()}
    return {**{f"silver_{n}": df for n, df in clean.items()}, **gold(clean)}


def run(lake: Lake, source: str) -> dict[str, DataFrame]:
    """From CSV files to stored gold tables. Silver is stored once and read by all three."""
    clean = {}
    for name in ENTITIES:
        raw = lake.store(bronze(lake.spark, source, name), "bronze", f"bronze_{name}")
        clean[name] = lake.store(silver(name, raw), "silver", f"silver_{name}")
    return {name: lake.store(df, "gold", name) for name, df in gold(clean).items()}


def serve(lake: Lake, target: str) -> None:
    """Replace the serving copies of the gold tables, each checked for its key."""
    for name, keys in snapshot.SERVED_KEYS.items():
        snapshot.sync_snapshot(lake.spark, lake.read("gold", name), f"{target}/{name}", keys)
