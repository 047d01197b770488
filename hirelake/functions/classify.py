"""Tagging and classification of posting text as native expressions.

Nothing here calls Python per row. A rule is tested in two steps: a substring test, which runs on the raw
bytes and rejects almost every text, then a regular expression only where a word boundary matters. The
expression starts with the literal, so the regex engine can search for it before it looks at the boundary.

Rules become SQL text that Spark parses once; the same tree built from Column objects costs a call to the JVM
per node. The public functions therefore take SQL expressions, usually just column names.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelake.functions import rules
from hirelake.functions.text import SPACE_CLASS

_WORD = r"[\p{L}\p{N}_]"
_BOUNDARY = rf"(?:(?<={_WORD})(?!{_WORD})|(?<!{_WORD})(?={_WORD}))"


def word_regex(regex: str) -> str:
    """Java form of a regular expression whose ``\\b`` and ``\\s`` follow Unicode, whatever the Java version."""
    return regex.replace(r"\b", _BOUNDARY).replace(r"\s", SPACE_CLASS)


def _quoted(text: str) -> str:
    if "'" in text:
        raise ValueError(f"a rule must not hold a quote: {text}")
    return f"r'{text}'"


def _lower(text: str) -> str:
    return f"lower(coalesce({text}, ''))"


def _literal(pattern: str) -> str:
    return pattern.replace(r"\b", "").replace(r"\.", ".")


def _is_word(char: str) -> bool:
    return char.isalnum() or char == "_"


def _bounded_regex(pattern: str) -> str:
    """``\\bword\\b`` with the literal in front and the boundary checks behind it."""
    literal = re.escape(_literal(pattern))
    checks = ""
    if pattern.startswith(r"\b"):
        look = "<!" if _is_word(_literal(pattern)[0]) else "<="
        checks += f"(?{look}{_WORD}{literal})"
    if pattern.endswith(r"\b"):
        look = "!" if _is_word(_literal(pattern)[-1]) else "="
        checks += f"(?{look}{_WORD})"
    return literal + checks


def _mentions_one(text: str, pattern: str) -> str:
    found = f"contains({text}, {_quoted(_literal(pattern))})"
    return f"({found} AND {text} RLIKE {_quoted(_bounded_regex(pattern))})" if r"\b" in pattern else found


def _mentions(text: str, patterns: Iterable[str]) -> str:
    patterns = list(patterns)
    literals = list(dict.fromkeys(_literal(p) for p in patterns))
    # literals that hold no other literal: if none of them occurs, no pattern can match
    gates = [x for x in literals if not any(y != x and y in x for y in literals)]
    tests = " OR ".join(_mentions_one(text, p) for p in patterns)
    if len(patterns) == 1 or len(gates) == len(literals):
        return f"({tests})"
    return f"(({' OR '.join(f'contains({text}, {_quoted(x)})' for x in gates)}) AND ({tests}))"


def mentions(text: str, patterns: Iterable[str]) -> Column:
    """True where the lower-cased ``text`` holds one of the rule patterns (see ``rules``)."""
    return F.expr(_mentions(text, patterns))


def _tags(lowered: str, tags: Mapping[str, Iterable[str]]) -> Column:
    hits = [f"if({_mentions(lowered, tags[name])}, {_quoted(name)}, '')" for name in sorted(tags)]
    return F.expr(f"array_remove(array({', '.join(hits)}), '')")


def _branches(value: str, groups: Mapping[str, Iterable[str]]) -> str:
    return " ".join(f"WHEN {_mentions(value, patterns)} THEN '{label}'" for label, patterns in groups.items())


def _remote(location: str, head: str) -> Column:
    tests = [_branches(v, rules.REMOTE_PATTERNS) for v in (location, head)]
    return F.expr(f"CASE {' '.join(tests)} ELSE '{rules.UNKNOWN}' END")


def _seniority(title: str, head: str, years: str) -> Column:
    tests = [_branches(v, rules.SENIORITY_PATTERNS) for v in (title, head)]
    # every experience rule needs one of the unit words, so most texts end here without a regular expression
    units = " OR ".join(f"contains({years}, '{unit}')" for unit in rules.EXPERIENCE_UNITS)
    tests.append(f"WHEN NOT ({units}) THEN '{rules.UNKNOWN}'")
    for label, regex in rules.EXPERIENCE_REGEXES:
        tests.append(f"WHEN {years} RLIKE {_quoted(word_regex(regex))} THEN '{label}'")
    return F.expr(f"CASE {' '.join(tests)} ELSE '{rules.UNKNOWN}' END")


def _head(lowered: str, chars: int = rules.HEAD_CHARS) -> str:
    return f"substring({lowered}, 1, {chars})"


def _years_window(experience: str, head: str) -> str:
    return f"concat({_lower(experience)}, ' ', {_head(head, rules.EXPERIENCE_HEAD_CHARS)})"


def tag_skills(text: str, tags: Mapping[str, Iterable[str]] = rules.TAG_PATTERNS) -> Column:
    """Sorted array of the tags whose patterns occur anywhere in the text; empty for null or blank text.

    The tag names are sorted here, once, so no row has to sort or deduplicate its result.
    """
    return _tags(_lower(text), tags)


def sort_skill_list(skills: Column) -> Column:
    """Sorted distinct names of any skill array."""
    return F.sort_array(F.array_distinct(skills))


def skills_csv(skills: Column) -> Column:
    """Comma list of a skill array; '' (not null) when there are none."""
    return F.concat_ws(",", skills)


def classify_remote(location: str, text: str) -> Column:
    """Work format from the location, else from the head of the text, else 'unknown'."""
    return _remote(_lower(location), _head(_lower(text)))


def classify_seniority(title: str, experience: str, text: str) -> Column:
    """Seniority from the title, else the head of the text, else years of experience, else 'unknown'."""
    head = _head(_lower(text))
    return _seniority(_lower(title), head, _years_window(experience, head))


def with_classification(
    df: DataFrame,
    *,
    title: str = "title",
    location: str = "location",
    experience: str = "experience_text",
    text: str = "text_blob",
    tags: Mapping[str, Iterable[str]] = rules.TAG_PATTERNS,
) -> DataFrame:
    """Add ``skills_array``, ``remote_type`` and ``seniority``, lower-casing each text once per row.

    Same results as the three column functions. Branches of a CASE do not share work, so the lowered text and
    its head go through projections of their own; Catalyst keeps those apart and prunes the ones not used.
    """
    lowered = df.select(
        "*",
        F.expr(_lower(text)).alias("_text"),
        F.expr(_lower(title)).alias("_title"),
        F.expr(_lower(location)).alias("_location"),
        F.expr(experience).alias("_experience"),
    )
    headed = lowered.select("*", F.expr(_head("_text")).alias("_head"))
    headed = headed.select("*", F.expr(_years_window("_experience", "_head")).alias("_years"))
    return headed.select(
        *df.columns,
        _tags("_text", tags).alias("skills_array"),
        _remote("_location", "_head").alias("remote_type"),
        _seniority("_title", "_head", "_years").alias("seniority"),
    )
