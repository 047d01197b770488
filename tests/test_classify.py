"""Every behaviour of the rules, as one table of cases per function, each run as one DataFrame."""

import pytest
from pyspark.sql import functions as F

from hirelake.functions import rules
from hirelake.functions.classify import (
    classify_remote,
    classify_seniority,
    mentions,
    skills_csv,
    sort_skill_list,
    tag_skills,
    with_classification,
)

TAG_CASES = [
    (None, ""),
    ("", ""),
    ("  \t\n", ""),
    ("PYTHON / Sql", "python,sql"),
    ("runs on PostgreSQL", "postgres,sql"),
    ("MySQL server", "sql"),
    ("MySQLi", "sql"),
    ("nosql", "nosql"),
    ("sql_dialect, sqlite", ""),
    ("T-SQLx", "sql"),
    ("see GitHub Actions", "ci/cd,git"),
    ("github", "git"),
    ("digital legit gitops", ""),
    ("git.", "git"),
    ("Jenkins!", "ci/cd"),
    ("Azure DevOps", "azure,ci/cd"),
    ("Azure Databricks", "azure,databricks"),
    ("azuredatabricks", ""),
    ("(dbt)[airflow]{kafka}", "airflow,dbt,kafka"),
    ("dbt_utils", ""),
    ("Apache Sparkling", "spark"),
    ("sparkling", ""),
    ("pyspark", "spark"),
    ("javascript", ""),
    ("java; scala", "java,scala"),
    ("Power BI", "power bi"),
    ("powerbi", ""),
    ("k8s", "kubernetes"),
    ("Amazon S3 only", "aws"),
    ("aws2", ""),
    ("Google Clouds", "gcp"),
    ("shell scripting", "bash"),
    ("знання SQLу", ""),
    ("знання SQL, Python", "python,sql"),
    ("égité", ""),
    ("sql²", ""),
    ("x " * 3000 + "oracle", "oracle"),
    ("superset,looker,tableau", "looker,superset,tableau"),
    ("ETL ELT", "elt,etl"),
    ("SQL sql Sql", "sql"),
]

REMOTE_CASES = [
    (None, None, "unknown"),
    ("", "", "unknown"),
    ("Remote", "in the office", "remote"),
    ("Lviv", "Fully remote team", "remote"),
    ("Lviv", "remoteness", "unknown"),
    ("Lviv", "remotely", "remote"),
    ("Віддалено", "", "remote"),
    ("Дистанційна робота", "hybrid", "remote"),
    ("Гібридна", "remote", "hybrid"),
    ("комбінований", "remote", "hybrid"),
    ("в офісі", "remote", "onsite"),
    ("Office, Kyiv", "remote", "onsite"),
    ("Kyiv", "home office", "remote"),
    ("Kyiv", "office-based", "onsite"),
    ("Kyiv", "on-site", "onsite"),
    ("Kyiv", "hybrid, then office", "hybrid"),
    ("Kyiv", "x" * 1493 + " remote", "remote"),
    ("Kyiv", "x" * 1494 + " remote", "unknown"),
    ("Kyiv", "ї" * 1493 + " remote", "remote"),
    ("x" * 2000 + " remote", "", "remote"),
]

SENIORITY_CASES = [
    (None, None, None, "unknown"),
    ("Lead Engineer", None, "junior", "lead"),
    ("Head of Data", None, "", "lead"),
    ("Тімлід, дані", None, "", "lead"),
    ("Engineer", None, "слід знати", "lead"),
    ("Engineer", None, "лідер", "unknown"),
    ("Engineer", None, "misleading", "unknown"),
    ("Senior Lead", None, "", "lead"),
    ("Sr. Engineer", None, "", "senior"),
    ("Старший інженер", None, "", "senior"),
    ("Старша інженерка", None, "", "unknown"),
    ("Mid-level", None, "", "middle"),
    ("Middleware engineer", None, "", "unknown"),
    ("Jr developer", None, "", "junior"),
    ("Engineer", None, "an international team", "junior"),
    ("Engineer", None, "trainee", "junior"),
    ("Engineer", None, "middle or junior", "middle"),
    ("Engineer", None, "y" * 1493 + " senior", "senior"),
    ("Engineer", None, "y" * 1494 + " senior", "unknown"),
    ("Engineer", "5+ years", "", "senior"),
    ("Engineer", "10 years", "", "senior"),
    ("Engineer", "15 years", "", "unknown"),
    ("Engineer", "3 роки", "", "middle"),
    ("Engineer", "4 рок", "", "middle"),
    ("Engineer", "1 рік", "", "unknown"),
    ("Engineer", "3 рік", "", "unknown"),
    ("Engineer", "від 6 року", "", "senior"),
    ("Engineer", "від 3 рокив", "", "middle"),
    ("Engineer", "2 years, від 5 рокив", "", "unknown"),
    ("Engineer", "3 years", "and 5 years", "senior"),
    ("Engineer", "5 years", "", "senior"),
    ("Engineer", "", "z" * 790 + " 7 years", "senior"),
    ("Engineer", "", "z" * 794 + " 7 years", "unknown"),
    ("Middle Engineer", "5 years", "", "middle"),
]


def test_tags(spark):
    df = spark.createDataFrame([(i, t, e) for i, (t, e) in enumerate(TAG_CASES)], "i int, t string, e string")
    got = df.select("i", "e", skills_csv(tag_skills("t")).alias("g")).where("e <> g or g is null").collect()
    assert [(TAG_CASES[r.i][0][-40:], r.e, r.g) for r in got] == []


def test_tags_are_arrays_and_sorted(spark):
    row = spark.sql("SELECT 'sql python airflow' AS t").select(tag_skills("t")).head()
    assert row[0] == ["airflow", "python", "sql"]


def test_remote(spark):
    df = spark.createDataFrame(REMOTE_CASES, "l string, t string, e string")
    assert df.select("l", "e", classify_remote("l", "t").alias("g")).where("e <> g").collect() == []


def test_seniority(spark):
    df = spark.createDataFrame(SENIORITY_CASES, "title string, x string, t string, e string")
    got = df.select("title", "x", "e", classify_seniority("title", "x", "t").alias("g"))
    assert got.where("e <> g").collect() == []


def test_staged_form_equals_column_functions(spark):
    texts = [t for t, _ in TAG_CASES] + [t for _, t, _ in REMOTE_CASES] + [t for _, _, t, _ in SENIORITY_CASES]
    rows = [(t, (t or "")[:20], (t or "")[-20:], t) for t in texts]
    df = spark.createDataFrame(rows, "text_blob string, title string, location string, experience_text string")
    staged = with_classification(df).select(
        "*",
        tag_skills("text_blob").alias("a"),
        classify_remote("location", "text_blob").alias("b"),
        classify_seniority("title", "experience_text", "text_blob").alias("c"),
    )
    assert staged.where("skills_array <> a or remote_type <> b or seniority <> c").count() == 0


def test_own_rule_set(spark):
    df = spark.sql("SELECT 'red apple' AS t")
    assert df.select(tag_skills("t", {"b": ["pear"], "a": [r"\bapple\b"]})).head()[0] == ["a"]
    assert df.where(mentions("t", [r"\bred\b"])).count() == 1


def test_quote_in_rule_is_refused():
    with pytest.raises(ValueError):
        tag_skills("t", {"x": ["it's"]})


def test_sort_skill_list(spark):
    assert spark.range(1).select(sort_skill_list(F.array(F.lit("b"), F.lit("a"), F.lit("b")))).head()[0] == ["a", "b"]


def test_rule_tables_are_complete():
    assert len(rules.TAG_PATTERNS) == 35
    assert set(rules.REMOTE_PATTERNS) | {"unknown"} == set(rules.REMOTE_TYPES)
    assert set(rules.SENIORITY_PATTERNS) | {"unknown"} == set(rules.SENIORITIES)
