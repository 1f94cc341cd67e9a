"""Regular expression helpers shared by all column expressions."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import WS

_WORD = "[A-Za-z0-9_]"
_AFTER = f"(?<!{_WORD})"
_BEFORE = f"(?!{_WORD})"
_EDGE = f"(?:(?<={_WORD}){_BEFORE}|{_AFTER}(?={_WORD}))"
# What a boundary stands beside, directly or as every branch of a flat group.
_STARTS_WORD = re.compile(r"(?:\\d|[A-Za-z0-9])")
_STARTS_HANGUL = re.compile("[가-힣]")
_FLAT_GROUP = re.compile(r"\((?:\?:)?([^()]*)\)")


def _branches_are(pattern: str, at: int, check) -> bool:
    group = _FLAT_GROUP.match(pattern, at)
    return bool(group) and all(check(branch) for branch in group.group(1).split("|"))


def java(pattern: str) -> str:
    """Make ``\\b`` an ASCII word boundary and ``\\s`` cover Unicode space for Spark's Java regex.

    Beside an ASCII word character a boundary is a single look-around, which is much cheaper than the general form.
    """
    out, i = [], 0
    while i < len(pattern):
        if not pattern.startswith(r"\b", i):
            step = 2 if pattern[i] == "\\" else 1
            out.append(pattern[i : i + step])
            i += step
            continue
        after = i + 2
        done = "".join(out)
        opened = done.rfind("(")
        ends_word = bool(re.search(r"(?:^|[^\\])[A-Za-z0-9]$", done)) or (
            done.endswith(")") and opened >= 0 and _branches_are(done, opened, lambda b: bool(re.search(r"[A-Za-z0-9]$", b)))
        )
        ends_hangul = bool(re.search("[가-힣]$", done)) or (
            done.endswith(")") and opened >= 0 and _branches_are(done, opened, lambda b: bool(re.search("[가-힣]$", b)))
        )
        if _STARTS_WORD.match(pattern, after) or _branches_are(pattern, after, lambda b: bool(_STARTS_WORD.match(b))):
            out.append(_AFTER)
        elif ends_word:
            out.append(_BEFORE)
        elif _STARTS_HANGUL.match(pattern, after) or _branches_are(pattern, after, lambda b: bool(_STARTS_HANGUL.match(b))):
            out.append(f"(?<={_WORD})")
        elif ends_hangul:
            out.append(f"(?={_WORD})")
        else:
            out.append(_EDGE)
        i = after
    return "".join(out).replace(r"[\s", f"[{WS}").replace(r"\s", f"[{WS}]")


# A group that stands first, without a quantifier and with groups of one level at most.
_GROUP = re.compile(r"\((?:\?:)?(?!\?)((?:[^()\\]|\\.|\((?:[^()\\]|\\.)*\))*)\)(?![?*{])", re.S)


def _branches(pattern: str) -> list[str]:
    """Alternatives of a pattern at its top level."""
    out, depth, inside, i = [""], 0, False, 0
    while i < len(pattern):
        c = pattern[i : i + 2] if pattern[i] == "\\" else pattern[i]
        i += len(c)
        if c == "|" and not depth and not inside:
            out.append("")
            continue
        if c == "[":
            inside = True
        elif c == "]":
            inside = False
        elif not inside:
            depth += {"(": 1, ")": -1}.get(c, 0)
        out[-1] += c
    return out


def _firsts(pattern: str) -> str | None:
    """What a match can start with, as the content of a character class; None where that is not plain."""
    found = ""
    for branch in _branches(pattern):
        branch = re.sub(r"^(?:\\b)+", "", branch)
        group = _GROUP.match(branch)
        if group:
            first = _firsts(group.group(1))
        else:
            atom = re.match(r"([가-힣A-Za-z0-9]|\\\[|\[(?!\^)[^\[\]\\&]+\])(?![?*{])", branch)
            first = None if not atom else atom.group(1) if len(atom.group(1)) < 3 else atom.group(1)[1:-1]
        if first is None:
            return None
        found += first
    return found


def led(pattern: str) -> str:
    """:func:`java` of the pattern, behind a look-ahead for the characters that it can start with: most places of a text fail it at
    once, however many alternatives there are. Hangul counts as one range there."""
    whole, flag = java(pattern), "(?i)" if pattern.startswith("(?i)") else ""
    first = _firsts(pattern[len(flag) :])
    if first is None or "-" in first:  # a range is looked up as fast by itself
        return whole
    hangul = "가-힣" if re.search("[가-힣]", first) else ""
    return f"{flag}(?=[{hangul}{re.sub('[가-힣]', '', first)}])(?:{whole[len(flag) :]})"


def needs_hangul(pattern: str) -> bool:
    """Whether every match of the pattern starts with a Hangul character."""
    return re.fullmatch("[가-힣]+", _firsts(pattern.removeprefix("(?i)")) or "") is not None


# What does not have to stand in a match: groups, classes, escapes and whatever a quantifier follows.
_LOOSE = re.compile(r"(?:\((?:[^()\\]|\\.|\((?:[^()\\]|\\.)*\))*\)|\[(?:[^\]\\]|\\.)+\]|\\.|.(?=[?*+{]))(?:[?*+]|\{[^}]*\})?|[.^$|]", re.S)
_OPTIONAL = re.compile(r"\\.|\[(?:[^\]\\]|\\.)+\]|\((?:[^()\\]|\\.|\((?:[^()\\]|\\.)*\))*\)[?*{]", re.S)
_BOUNDS = re.compile(r"^(?:\\b)+|(?:\\b)+$")


def needs(pattern: str) -> tuple[frozenset[str], bool] | None:
    """Lower-case pieces without white space, and whether Hangul counts as one, of which every match of the pattern holds one; None
    where a match needs no plain piece."""
    pieces, hangul = set(), False
    for branch in _branches(pattern.removeprefix("(?i)")):
        body = _BOUNDS.sub("", branch)
        plain = _LOOSE.sub("\n", body).split()
        if re.search(r"[()\[\]]", "".join(plain)):  # deeper than is read here
            return None
        if re.search("[가-힣]", "".join(plain)):
            hangul = True
        elif max(map(len, plain), default=0) >= 3:
            pieces.add(max(plain, key=len).lower())
        else:
            group = _GROUP.search(_OPTIONAL.sub("\n", body))
            inner = needs(group.group(1)) if group else None
            if inner is None:
                return None
            pieces, hangul = pieces | inner[0], hangul or inner[1]
    return frozenset(pieces), hangul


def matches(col: Column, pattern: str) -> Column:
    return F.coalesce(F.regexp_like(col, F.lit(led(pattern))), F.lit(False))


def count(col: Column, pattern: str) -> Column:
    return F.regexp_count(col, F.lit(led(pattern)))


def find_all(col: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(col, F.lit(java(pattern)), F.lit(group))


def replace(col: Column, pattern: str, replacement: str) -> Column:
    return F.regexp_replace(col, java(pattern), replacement)


#: One character of white space, and one that is not a blank. Other characters of Latin texts fail the first half at once.
BLANK = f"[[^\\x0e-\\x1f!-\\x9f]&&[{WS}]]"
ODD = f"[[^\\x0e-\\x9f]&&[{WS}]]"
#: Runs of white space that are not already one blank, which most are: a text has a match for each of these only.
RUNS = f" {BLANK}+|{ODD}{BLANK}*"


def squeeze(col: Column) -> Column:
    """Collapse white space runs to one space and trim. Runs of blanks are looked for only where two blanks meet."""
    return squeeze_blanks(F.regexp_replace(col, f"{ODD}+", " "))


def squeeze_blanks(col: Column) -> Column:
    """:func:`squeeze` of a text without other white space than blanks."""
    return F.trim(once(col, lambda v: F.when(F.contains(v, F.lit("  ")), F.regexp_replace(v, "  +", " ")).otherwise(v)))


def strip(col: Column) -> Column:
    """Trim every kind of white space, not only blanks."""
    return F.regexp_replace(col, f"^[{WS}]+|[{WS}]+$", "")


def strip_plain(col: Column) -> Column:
    """:func:`strip` of a column or lambda variable, which is looked at several times: only texts with white space at an end are
    searched. A line end counts, since ``$`` stands before the last one too."""
    ends = F.concat(F.left(col, F.lit(1)), F.right(col, F.lit(1)))
    return F.when(F.regexp_like(ends, F.lit(f"[{WS}\u0085]")), strip(col)).otherwise(col)


def compact(col: Column) -> Column:
    """Drop all white space."""
    return F.regexp_replace(F.replace(col, F.lit(" "), F.lit("")), f"{ODD}+", "")


def text(col: Column) -> Column:
    return F.coalesce(col.cast("string"), F.lit(""))


def joined(*cols: Column) -> Column:
    """Join the non-empty parts with one blank (arrays must be joined by the caller)."""
    parts = [F.when(F.length(c) > 0, c) for c in cols]
    return F.concat_ws(" ", *parts)


def codes(*pairs: tuple[Column, str]) -> Column:
    """``array<string>`` of the codes whose condition holds, in order; null conditions count as false."""
    return F.array_compact(F.array(*[F.when(cond, F.lit(code)) for cond, code in pairs]))


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it is looked at there."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def settle(df: DataFrame, **columns: Column) -> DataFrame:
    """Add computed columns behind a one-row generator.

    Catalyst copies a filter on a computed column down to the scan and evaluates the whole expression there again; it
    does not push filters through a generator, so expensive rule codes are computed once.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))
