"""Repeatable invented data. Every generator is a projection of a DataFrame of ids (column
id, values 0..n-1): a value depends on the id and a salt only, so rows come out the same on
any number of tasks, a child can work out its parent's values without a join, and a re-run
task gives what the lost one gave."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions import labels


def _numbered(prefix: str, n: int) -> list[str]:
    return [f"{prefix}{k}" for k in range(1, n + 1)]


# Labels without a meaning of their own are numbered.
LEVELS = _numbered("level ", 6)
SPANS = [f"{low} to {high}" for low, high in zip(LEVELS, LEVELS[2:])]
SCHOOL_KINDS = _numbered("kind ", 3)
CERTIFICATES = _numbered("certificate ", 5)
COURSES = _numbered("course ", 7)
SUBJECTS = _numbered("subject ", 4)
TOPICS = 3  # a subject's, numbered
# Fixed value: classrooms ask for this role; the others only fill up.
LEAD = "lead_teacher"
ROLES = [LEAD, *_numbered("staff ", 3)]
EDUCATOR_STATUSES = ["active", "on_leave", "retired"]
STUDENT_STATUSES = ["active", "inactive", "transferred"]
ORDER_CATEGORIES = ["electronics", "clothing", "food", "books", "sports"]
ORDER_STATUSES = ["completed", "pending", "cancelled", "refunded"]
CLIENT_NAMES = ["Alder Works", "Birch Supply", "Cedar Labs", "Dogwood Bank", "Elm Stores"]
EVENT_TYPES = ["transaction", "login", "purchase", "update", "delete"]
MESSAGE_STATUSES = ["active", "pending", "completed", "failed"]
CHANNELS = ["web", "mobile", "api"]
REGIONS = ["us-east", "us-west", "eu-west", "ap-south"]
LOAD_NAMES = ["Alice", "Bob", "Charlie", "Diana", "Eve"]

FIRST_NAMES = ["Ada", "Ben", "Cleo", "Dan", "Eva", "Finn", "Gia", "Hugo", "Iris", "Jon"]
LAST_NAMES = ["Abel", "Berg", "Cole", "Dorn", "Ekman", "Frost", "Gold", "Hart", "Ivers"]
TOWNS = ["Ashford", "Brookside", "Cedarton", "Dunmore", "Elmwood", "Fairhaven"]
STATES = ["AZ", "CA", "GA", "IL", "MA", "NY", "OR", "TX", "VA", "WA"]
ROOM_NAMES = ["Acorns", "Bees", "Comets", "Daisies", "Eagles", "Foxes"]
MAIL_DOMAINS = ["example.com", "example.org", "example.net"]


def ids(spark: SparkSession, n: int) -> DataFrame:
    return spark.range(n)


def draw(id_: Column, salt: str, n: int) -> Column:
    """A number in 0..n-1 that depends on id and salt only."""
    return F.pmod(F.xxhash64(id_, F.lit(salt)), F.lit(n))


def one_of(id_: Column, salt: str, values: list[str]) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (draw(id_, salt, len(values)) + 1).cast("int"))


def between(id_: Column, salt: str, low: int, high: int) -> Column:
    return draw(id_, salt, high - low + 1) + low


def amount(id_: Column, salt: str, low: int, high: int, digits: int = 2) -> Column:
    """A value from low to high with the given number of decimals."""
    step = 10 ** digits
    return F.round((draw(id_, salt, (high - low) * step + 1) + low * step) / step, digits)


def days_back(id_: Column, salt: str, days: int, today: str) -> Column:
    return F.date_sub(F.lit(today).cast("date"), draw(id_, salt, days + 1).cast("int"))


def weighted(id_: Column, salt: str, values: list[str], weights: tuple[int, ...]) -> Column:
    """The first value in weights[0] percent of rows, and so on."""
    limits, total = [], 0
    for value, weight in zip(values, weights):
        total += weight
        limits.append((total, value))
    return labels.bands(draw(id_, salt, 100), limits[:-1], values[-1])


def _key(kind: str, number: Column) -> Column:
    return labels.numbered_name(f"{kind}-", number)


def schools(ids: DataFrame) -> DataFrame:
    i = F.col("id")
    return ids.select(
        _key("school", i).alias("school_id"),
        F.concat_ws(" ", one_of(i, "sn", LAST_NAMES),
                    one_of(i, "sx", ["Academy", "Elementary", "School"])).alias("name"),
        F.concat(one_of(i, "town", TOWNS), F.lit(" School District")).alias("district"),
        one_of(i, "state", STATES).alias("state"),
        one_of(i, "stype", SCHOOL_KINDS).alias("school_type"),
        one_of(i, "range", SPANS).alias("grade_range"),
        between(i, "cap", 50, 500).cast("int").alias("student_capacity"),
    )


def educators(ids: DataFrame, n_schools: int, today: str) -> DataFrame:
    """Every fourth educator, from the first on, is a lead teacher."""
    i = F.col("id")
    first, last = one_of(i, "ef", FIRST_NAMES), one_of(i, "el", LAST_NAMES)
    role = F.element_at(F.array(*map(F.lit, ROLES)), (F.pmod(i, F.lit(4)) + 1).cast("int"))
    return ids.select(
        _key("educator", i).alias("educator_id"),
        first.alias("first_name"), last.alias("last_name"),
        labels.email_address(first, last, i, one_of(i, "mail", MAIL_DOMAINS)).alias("email"),
        role.alias("role"),
        one_of(i, "cert", CERTIFICATES).alias("certification"),
        _key("school", draw(i, "eschool", n_schools)).alias("school_id"),
        days_back(i, "hired", 3650, today).alias("hire_date"),
        weighted(i, "estat", EDUCATOR_STATUSES, (85, 10, 5)).alias("status"),
    )


def _room_grade(room: Column) -> Column:
    return one_of(room, "grade", LEVELS)


def _room_school(room: Column, n_schools: int) -> Column:
    return _key("school", draw(room, "rschool", n_schools))


def classrooms(ids: DataFrame, n_schools: int, n_educators: int) -> DataFrame:
    """Classrooms led by lead teachers only."""
    i = F.col("id")
    leads = (n_educators + 3) // 4
    return ids.select(
        _key("classroom", i).alias("classroom_id"),
        F.concat(F.lit("Room "), between(i, "room", 100, 399).cast("string"), F.lit(" - "),
                 one_of(i, "rname", ROOM_NAMES)).alias("name"),
        _room_grade(i).alias("grade_level"),
        _room_school(i, n_schools).alias("school_id"),
        _key("educator", draw(i, "lead", leads) * 4).alias("educator_id"),
        between(i, "seats", 8, 30).cast("int").alias("capacity"),
        one_of(i, "program", COURSES).alias("program_type"),
    )


def students(ids: DataFrame, n_schools: int, n_classrooms: int, today: str) -> DataFrame:
    """Students take school and grade from their classroom."""
    i = F.col("id")
    room = draw(i, "seat", n_classrooms)
    age = between(i, "age", 3, 12) * 365 + draw(i, "bday", 365)
    return ids.select(
        _key("student", i).alias("student_id"),
        one_of(i, "pf", FIRST_NAMES).alias("first_name"),
        one_of(i, "pl", LAST_NAMES).alias("last_name"),
        F.date_sub(F.lit(today).cast("date"), age.cast("int")).alias("date_of_birth"),
        _room_grade(room).alias("grade_level"),
        _room_school(room, n_schools).alias("school_id"),
        _key("classroom", room).alias("classroom_id"),
        days_back(i, "enrolled", 1095, today).alias("enrollment_date"),
        weighted(i, "pstat", STUDENT_STATUSES, (85, 10, 5)).alias("status"),
    )


def _objective_subject(objective: Column) -> Column:
    return one_of(objective, "subject", SUBJECTS)


def _objective_domain(objective: Column) -> Column:
    return F.concat_ws(", topic ", _objective_subject(objective),
                       between(objective, "domain", 1, TOPICS).cast("string"))


def learning_objectives(ids: DataFrame) -> DataFrame:
    i = F.col("id")
    subject, domain, grade = _objective_subject(i), _objective_domain(i), one_of(i, "og", LEVELS)
    return ids.select(
        _key("objective", i).alias("objective_id"),
        subject.alias("subject"), domain.alias("domain"),
        F.concat_ws(": ", grade, domain).alias("description"),
        grade.alias("grade_level"),
        labels.standard_code(subject, between(i, "major", 1, 9).cast("string"),
                             between(i, "minor", 1, 9).cast("string")).alias("standard_code"),
    )


def assessments(ids: DataFrame, n_students: int, n_educators: int, n_objectives: int,
                today: str) -> DataFrame:
    i = F.col("id")
    objective, day = draw(i, "objective", n_objectives), days_back(i, "taken", 730, today)
    note = F.when(draw(i, "noted", 10) < 3, "Steady progress was seen.").otherwise("")
    return ids.select(
        _key("assessment", i).alias("assessment_id"),
        _key("student", draw(i, "student", n_students)).alias("student_id"),
        _key("educator", draw(i, "by", n_educators)).alias("educator_id"),
        _objective_subject(objective).alias("subject"),
        _objective_domain(objective).alias("domain"),
        amount(i, "score", 1, 9, digits=1).alias("score"),
        day.alias("assessment_date"),
        labels.season(day).alias("assessment_period"),
        _key("objective", objective).alias("learning_objective_id"),
        note.alias("notes"),
    )


def orders(ids: DataFrame, now: str) -> DataFrame:
    """Customer orders of the 90 days before now."""
    i = F.col("id")
    first, last = one_of(i, "of", FIRST_NAMES), one_of(i, "ol", LAST_NAMES)
    seconds = draw(i, "when", 90 * 86400)
    return ids.select(
        _key("order", i).alias("order_id"),
        F.concat_ws(" ", first, last).alias("customer_name"),
        labels.email_address(first, last, i, one_of(i, "om", MAIL_DOMAINS)).alias("email"),
        one_of(i, "os", STATES).alias("state"),
        amount(i, "oa", 5, 500).alias("order_amount"),
        one_of(i, "oc", ORDER_CATEGORIES).alias("category"),
        F.timestamp_seconds(F.unix_timestamp(F.lit(now).cast("timestamp")) - seconds)
        .alias("order_ts"),
        one_of(i, "ost", ORDER_STATUSES).alias("status"),
    )


def messages(ids: DataFrame, now: str) -> DataFrame:
    """Client messages of the hour before now, in the shape of a message body."""
    i = F.col("id")
    client = draw(i, "client", len(CLIENT_NAMES))
    name = F.element_at(F.array(*map(F.lit, CLIENT_NAMES)), (client + 1).cast("int"))
    seconds = draw(i, "mt", 3601)
    return ids.select(
        F.concat(F.lit("client_"), F.lpad((client + 1).cast("string"), 3, "0"))
        .alias("client_id"),
        name.alias("client_name"),
        F.timestamp_seconds(F.unix_timestamp(F.lit(now).cast("timestamp")) - seconds)
        .alias("timestamp"),
        one_of(i, "type", EVENT_TYPES).alias("event_type"),
        F.create_map(
            F.lit("key1"), labels.numbered_name("value_", between(i, "k1", 1, 100)),
            F.lit("key2"), labels.numbered_name("data_", between(i, "k2", 1, 100)),
            F.lit("source"), one_of(i, "ds", CHANNELS)).alias("data"),
        amount(i, "ma", 10, 5000).alias("amount"),
        one_of(i, "ms", MESSAGE_STATUSES).alias("status"),
        F.create_map(
            F.lit("source"), one_of(i, "mds", CHANNELS),
            F.lit("region"), one_of(i, "mr", REGIONS),
            F.lit("version"), F.lit("1.0")).alias("metadata"),
    )


def edge_case_messages(spark: SparkSession, now: str) -> DataFrame:
    """Four messages: a valid one, one without a time, one of unknown status and one with a
    negative amount. The second falls at the bronze rules, the last two at the silver rules."""
    cases = [(1, now, 100.0, "active"), (2, None, 50.0, "pending"),
             (3, now, 75.0, "invalid_status"), (4, now, -100.0, "completed")]
    rows = spark.createDataFrame(cases, "n INT, t STRING, amount DOUBLE, status STRING")
    return rows.select(
        F.concat(F.lit("client_00"), F.col("n")).alias("client_id"),
        F.concat(F.lit("Test Client "), F.col("n")).alias("client_name"),
        F.col("t").cast("timestamp").alias("timestamp"),
        F.lit("test").alias("event_type"),
        F.create_map(F.lit("test"), F.lit("data")).alias("data"),
        "amount", "status",
        F.create_map(F.lit("source"), F.lit("test")).alias("metadata"),
    )


def names(ids: DataFrame) -> DataFrame:
    i = F.col("id")
    return ids.select(draw(i, "nid", 100000).alias("id"), one_of(i, "nn", LOAD_NAMES).alias("name"))


def masked_emails(ids: DataFrame, today: str) -> DataFrame:
    i = F.col("id")
    return ids.select(
        i.alias("email_id"), draw(i, "cust", 1000).cast("int").alias("customer_id"),
        labels.numbered_name("Subject ", i).alias("subject"),
        labels.numbered_name("This is the content of email ", i).alias("content"),
        F.round(draw(i, "sent", 201) / 100 - 1, 2).alias("sentiment"),
        F.lit(today).cast("date").alias("received_date"),
        amount(i, "req", 0, 10000).alias("requested_amount"),
        F.when(draw(i, "proc", 2) == 1, "Y").otherwise("N").alias("processed"),
    )


def value_of(id_: Column) -> Column:
    """A value from 0 to 100 for the value pipeline."""
    return draw(id_, "value", 1_000_000) / 10_000.0
