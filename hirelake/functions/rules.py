"""Rule tables: which words mark a technology, a work format or a seniority level.

A pattern is a literal text; ``\\b`` at either end asks for a word boundary there and
``\\.`` is a full stop. Patterns are matched against lower-cased text.
"""

from __future__ import annotations

# Technology tags and the patterns that reveal each one.
TAG_PATTERNS: dict[str, tuple[str, ...]] = {
    "sql": (r"\bsql\b", r"postgresql", r"mysql", r"t-sql", r"pl/sql", r"\bms sql\b", r"\bmssql\b"),
    "python": (r"\bpython\b",),
    "spark": (r"\bspark\b", r"apache spark", r"\bpyspark\b"),
    "airflow": (r"\bairflow\b", r"apache airflow"),
    "dbt": (r"\bdbt\b",),
    "kafka": (r"\bkafka\b",),
    "aws": (r"\baws\b", r"amazon web services", r"amazon s3", r"aws glue", r"aws lambda"),
    "gcp": (r"\bgcp\b", r"google cloud"),
    "azure": (r"\bazure\b", r"azure data factory", r"azure synapse", r"microsoft azure"),
    "docker": (r"\bdocker\b",),
    "kubernetes": (r"\bkubernetes\b", r"\bk8s\b"),
    "terraform": (r"\bterraform\b",),
    "databricks": (r"\bdatabricks\b", r"azure databricks"),
    "snowflake": (r"\bsnowflake\b",),
    "postgres": (r"\bpostgres\b", r"\bpostgresql\b"),
    "etl": (r"\betl\b",),
    "elt": (r"\belt\b",),
    "power bi": (r"power bi", r"microsoft power bi"),
    "tableau": (r"\btableau\b",),
    "bigquery": (r"\bbigquery\b",),
    "redshift": (r"\bredshift\b", r"amazon redshift", r"aws redshift"),
    "git": (r"\bgit\b", r"github"),
    "ci/cd": (r"\bci/cd\b", r"\bcicd\b", r"gitlab ci", r"github actions", r"jenkins", r"azure devops"),
    "clickhouse": (r"\bclickhouse\b",),
    "java": (r"\bjava\b",),
    "scala": (r"\bscala\b",),
    "hadoop": (r"\bhadoop\b",),
    "flink": (r"\bflink\b", r"apache flink"),
    "bash": (r"\bbash\b", r"\bshell scripting\b"),
    "linux": (r"\blinux\b",),
    "mongodb": (r"\bmongodb\b", r"\bmongo\b"),
    "nosql": (r"\bnosql\b",),
    "oracle": (r"\boracle\b",),
    "looker": (r"\blooker\b",),
    "superset": (r"\bsuperset\b",),
}

# Work formats, in the order they are tried.
REMOTE_PATTERNS: dict[str, tuple[str, ...]] = {
    "remote": (
        r"\bremote\b", r"віддален", r"дистанц", r"remotely", r"work from home", r"home office", r"fully remote",
    ),
    "hybrid": (r"\bhybrid\b", r"гібрид", r"комбінован", r"змішан"),
    "onsite": (r"\bonsite\b", r"\boffice\b", r"офіс", r"office-based", r"on-site"),
}

# Seniority levels, in the order they are tried.
SENIORITY_PATTERNS: dict[str, tuple[str, ...]] = {
    "lead": (
        r"\blead\b", r"team lead", r"tech lead", r"chapter lead", r"head of", r"керівник", r"тімлід", r"лід\b",
    ),
    "senior": (r"\bsenior\b", r"\bsr\b", r"\bsr\.\b", r"старший"),
    "middle": (r"\bmiddle\b", r"\bmid\b", r"\bmid-level\b"),
    "junior": (r"\bjunior\b", r"\bjr\b", r"\bjr\.\b", r"молодший", r"intern", r"trainee"),
}

# Years of experience (full regular expressions), in the order they are tried.
EXPERIENCE_REGEXES: tuple[tuple[str, str], ...] = (
    ("senior", r"\b(5|6|7|8|9|10)\+?\s*(years|year|рок|роки|років)\b"),
    ("middle", r"\b(3|4)\+?\s*(years|year|рок|роки|років)\b"),
    ("unknown", r"\b(1|2)\+?\s*(years|year|рік|роки|років)\b"),
    ("senior", r"від\s*(5|6|7|8|9|10)\s*рок"),
    ("middle", r"від\s*(3|4)\s*рок"),
    ("unknown", r"від\s*(1|2)\s*рок"),
)

# Shortest stems of the unit words above: a text without any of them matches no experience rule.
EXPERIENCE_UNITS = ("year", "рок", "рік")

# How much of the text the classifiers read, in characters.
HEAD_CHARS = 1500
EXPERIENCE_HEAD_CHARS = 800

# Category domains.
UNKNOWN = "unknown"
REMOTE_TYPES = ("remote", "hybrid", "onsite", "unknown")
SENIORITIES = ("junior", "middle", "senior", "lead", "unknown")
SOURCES = ("workua", "dou", "ithub")

# Preference among sources when one vacancy is found in several; any other source ranks last.
SOURCE_PRIORITY = {"dou": 1, "ithub": 2, "workua": 3}
OTHER_SOURCE_PRIORITY = 9

# Title keywords that keep a posting of the keyword-filtered board.
TITLE_KEYWORDS = ("data engineer", "data engineering")
