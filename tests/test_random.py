"""Random small inputs, NULLs and orphans included, against plain models of the same results."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from strata.operators import quality
from strata.operators.quality import Rule
from strata.plans import education, emails, refresh_log
from strata.plans.refresh_log import COMPLETE, NO_RULES

from support import rows
from test_jobs import log_of, plan_event


def reason_model(entries):
    chosen = next((e for e in entries if e[0]), (None, None, None))
    issues = [e[2] for e in entries]
    if chosen[1] != COMPLETE:
        return chosen[1], "incremental recompute"
    if NO_RULES in issues[1:3]:
        return chosen[1], NO_RULES
    return chosen[1], next((i for i in issues if i), "UNKNOWN_ISSUE")


def test_refresh_reasons(spark):
    dice = random.Random(1)
    cases = {}
    for i in range(400):
        cases[f"u{i}"] = [
            (dice.choice([True, False, None]), dice.choice([COMPLETE, "OTHER_TYPE", None]),
             dice.choice([NO_RULES, "X", "Y", None])) for _ in range(dice.randrange(10))]
    log = log_of(spark, *[plan_event(u, *entries) for u, entries in cases.items()])
    got = {r.update_id: (r.chosen_maintenance_type, r.recompute_reason)
           for r in refresh_log.refreshes(log).collect()}
    assert got == {u: reason_model(entries) for u, entries in cases.items()}


def test_rules_split_without_loss(spark):
    dice = random.Random(2)
    data = [(i, dice.choice([None, "a", "b", "z"]), dice.choice([None, -1.0, 0.0, 2.5]))
            for i in range(500)]
    df = spark.createDataFrame(data, "id INT, s STRING, v DOUBLE")
    rules = [Rule("known", "s IN ('a', 'b')"), Rule("positive", "v >= 0"),
             Rule("both", "s = 'a' OR v > 1")]
    kept = {r.id for r in quality.enforce(df, rules).collect()}
    bad = {r.id: r.failed_rules for r in quality.rejected(df, rules).collect()}
    assert kept.isdisjoint(bad) and kept | set(bad) == set(range(500))

    for i, s, v in data:
        either = s == "a" or (v is not None and v > 1)
        want = [n for n, ok in (("known", s in ("a", "b")), ("positive", v is not None and v >= 0),
                                ("both", either)) if not ok]
        assert bad.get(i, []) == want
    counts = {r.rule: r.failed for r in quality.rule_counts(df, rules).collect()}
    assert counts == {n: sum(n in names for names in bad.values())
                      for n in ("known", "positive", "both")}


@pytest.fixture(scope="module")
def school_data(spark):
    dice = random.Random(3)

    def some(prefix, n, gaps=True):
        return dice.choice([f"{prefix}{i}" for i in range(n)] + ([None, f"{prefix}x"] if gaps else []))

    made = {
        "schools": ([(f"s{i}", f"S{i}", "d", "st", "t") for i in range(6)],
                    "school_id STRING, name STRING, district STRING, state STRING, school_type STRING"),
        "educators": ([(f"e{i}", f"E{i}", "L", "r", some("s", 6)) for i in range(15)],
                      "educator_id STRING, first_name STRING, last_name STRING, role STRING, school_id STRING"),
        "classrooms": ([(f"r{i}", f"R{i}", "g", some("s", 6), some("e", 15)) for i in range(12)],
                       "classroom_id STRING, name STRING, grade_level STRING, school_id STRING, educator_id STRING"),
        "students": ([(f"p{i}", some("s", 6), some("r", 12)) for i in range(60)],
                     "student_id STRING, school_id STRING, classroom_id STRING"),
        "assessments": ([(f"a{i}", some("p", 60), dice.choice(["math", "art"]),
                          dice.choice([None, 1.0, 2.5, 4.0, 8.75]), dice.choice(["fall", "winter"]))
                         for i in range(400)],
                        "assessment_id STRING, student_id STRING, subject STRING, score DOUBLE, "
                        "assessment_period STRING"),
    }
    return {n: spark.createDataFrame(*d) for n, d in made.items()}


def test_education_against_plain_joins(school_data):
    d = school_data
    ours = education.gold(d)
    for name, df in d.items():
        df.createOrReplaceTempView(name)
    sql = d["schools"].sparkSession.sql
    summary = sql("""
        SELECT c.classroom_id, c.name AS classroom_name, c.grade_level, sc.school_id,
               sc.name AS school_name, subject, assessment_period,
               count(DISTINCT a.student_id), round(avg(score), 2), min(score), max(score),
               round(stddev(score), 2)
        FROM assessments a JOIN students s ON a.student_id = s.student_id
        JOIN classrooms c ON s.classroom_id = c.classroom_id
        JOIN schools sc ON c.school_id = sc.school_id GROUP BY 1, 2, 3, 4, 5, 6, 7""")
    assert rows(ours["assessment_summary_by_classroom"]) == rows(summary)
    metrics = sql("""
        SELECT e.educator_id, first_name, last_name, role, sc.name, count(DISTINCT s.student_id),
               count(DISTINCT assessment_id), round(avg(score), 2), count(DISTINCT c.classroom_id)
        FROM educators e JOIN classrooms c ON e.educator_id = c.educator_id
        JOIN students s ON s.classroom_id = c.classroom_id
        JOIN assessments a ON a.student_id = s.student_id
        JOIN schools sc ON e.school_id = sc.school_id GROUP BY 1, 2, 3, 4, 5""")
    assert rows(ours["educator_performance_metrics"]) == rows(metrics)
    overview = sql("""
        SELECT sc.school_id, sc.name, district, state, school_type, count(DISTINCT s.student_id),
               count(DISTINCT e.educator_id), count(DISTINCT c.classroom_id),
               round(avg(score), 2), count(DISTINCT assessment_id)
        FROM schools sc LEFT JOIN classrooms c ON sc.school_id = c.school_id
        LEFT JOIN students s ON s.school_id = sc.school_id
        LEFT JOIN educators e ON e.school_id = sc.school_id
        LEFT JOIN assessments a ON a.student_id = s.student_id GROUP BY 1, 2, 3, 4, 5""")
    assert rows(ours["school_performance_overview"]) == rows(overview)


def test_email_summary_against_a_model(spark):
    dice = random.Random(4)
    orgs, flags = ["o", "p"], [True, False, None]
    attachments = [(f"a{dice.randrange(60)}", f"m{dice.randrange(25)}", dice.choice(["d1", "d2", None]),
                    dice.choice([None, 0, 5, 2048]), dice.choice(orgs)) for _ in range(150)]
    people = [(f"m{dice.randrange(25)}", dice.choice(orgs),
               dice.choice(["to", "cc", "bcc", "reply_to", "odd", None]), dice.choice(flags),
               dice.choice(flags)) for _ in range(200)]
    hits = spark.createDataFrame([("d1", f"h{i}") for i in range(4)],
                                 "drive_item_unique_id STRING, hit_id STRING")
    hits = hits.withColumns({c: F.lit(None).cast(t) for c, t in {
        "sit_id": "string", "sit_name": "string", "hit_rank": "int", "summary": "string",
        "classification_type": "string", "classification_last_scan": "timestamp"}.items()})
    att = spark.createDataFrame(
        attachments, "attachment_unique_id STRING, email_unique_id STRING, "
        "drive_item_unique_id STRING, size BIGINT, rls_org_key STRING").withColumns(
        {c: F.lit("x") for c in ("attachment_type", "reference_type")})
    per = spark.createDataFrame(
        people, "unique_email_id STRING, rls_org_key STRING, recipient_type STRING, "
        "recipient_address_domain_is_external BOOLEAN, recipient_address_domain_is_consumer BOOLEAN")
    got = emails.email_summary(per, emails.attachment_hits(att, hits)).select(
        "unique_email_id", "rls_org_key", "recipient_count", "external_recipient_count",
        "has_consumer_recipient", "attachment_count", "attachment_size")

    sizes = defaultdict(dict)
    for a, m, _, size, org in attachments:
        best = sizes[m, org].get(a)
        sizes[m, org][a] = size if best is None else best if size is None else max(size, best)
    groups = defaultdict(list)
    for m, org, *rest in people:
        groups[m, org].append(rest)
    want = []
    for (m, org), members in groups.items():
        real = [x for x in members if x[0] in ("to", "cc", "bcc")]
        files = sizes.get((m, org), {})
        want.append((m, org, len(real), sum(x[1] is True for x in real),
                     any(x[2] is True for x in real), len(files),
                     sum(s or 0 for s in files.values())))
    assert rows(got) == sorted(want, key=repr)
