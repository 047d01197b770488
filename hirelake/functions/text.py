"""Text clean-up as native column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# every character that counts as white space in Unicode, plus the four ASCII separators; one category test
# beside the low range keeps the class cheap for characters that are no space
SPACE_CLASS = r"[\t-\r\x1c-\x20\x85\p{Z}]"

# Letters and digits that survive in a normalised name.
NAME_JUNK = "[^a-zA-Zа-яА-ЯіїєґІЇЄҐ0-9]+"


def lower_or_empty(value: Column) -> Column:
    return F.lower(F.coalesce(value, F.lit("")))


def is_blank(value: Column) -> Column:
    """Null, empty, or nothing but spaces (a tab is content)."""
    return F.coalesce(F.length(F.trim(value)), F.lit(0)) == 0


def collapse_space(value: Column) -> Column:
    """Runs of Unicode white space become one space; the ends are trimmed; null becomes ''."""
    return F.trim(F.regexp_replace(F.coalesce(value, F.lit("")), f"{SPACE_CLASS}+", " "))


def strip_space(value: Column) -> Column:
    """Unicode white space cut from both ends; null becomes ''."""
    return F.regexp_replace(F.coalesce(value, F.lit("")), f"^{SPACE_CLASS}+|{SPACE_CLASS}+$", "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once, however often the body names it.

    The value becomes a lambda variable. Written out instead, every use would be a copy of the whole expression, and copies of
    copies outgrow the code generator.
    """
    return F.get(F.transform(F.array(value), body), 0)


def _without_blocks(page: Column, tag: str) -> Column:
    """``<tag …> … </tag>`` becomes a space, from an opener to the next closer after its ``>``, any case.

    The first opener that finds no end takes the rest of the page, unchanged but for a space at its end. What it takes no
    later opener can match either, so at most one opener reads to the end in vain, and the step is linear.
    """
    return F.regexp_replace(page, rf"(?is)<{tag}(?:[^>]*+>.*?</{tag}>|(?<=(<{tag}))(.*+))", "$1$2 ")


# a run of tags and white space; possessive, so a long run needs no stack, and its first character is tested once
_GAP = rf"(?=[<\t-\r\x1c-\x20\x85\p{{Z}}])(?:<[^>]++>|{SPACE_CLASS}++)++"


def _without_tags(page: Column) -> Column:
    """Tags become a space, white space collapses. Behind the last ``>`` there is no tag; before it every ``<`` has an
    end and is tried once."""
    def joined(tail: Column) -> Column:
        tagged = F.substr(page, F.lit(1), F.length(page) - F.length(tail))
        rest = F.regexp_replace(tail, f"{SPACE_CLASS}++", " ")
        return F.trim(F.concat(F.regexp_replace(tagged, _GAP, " "), F.ltrim(rest)))

    return let(F.substring_index(page, ">", -1), joined)


def html_to_text(html: Column) -> Column:
    """Visible text of a page: scripts, styles and tags removed, entities left as they are, null becomes ''.

    Every step is linear in the page, also where tags are cut off or never closed, and the page is named once.
    """
    return let(_without_blocks(_without_blocks(F.coalesce(html, F.lit("")), "script"), "style"), _without_tags)


def normalize_name(name: Column) -> Column:
    """Comparison form of a title or company: letters and digits only, single spaces, lower case."""
    return F.lower(F.trim(F.regexp_replace(F.coalesce(name, F.lit("")), NAME_JUNK, " ")))
