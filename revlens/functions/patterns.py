"""Literals that a regular expression cannot match without."""

from __future__ import annotations

# fixed values: escapes that stand for a class, an anchor or one white space character
_CLASSES = frozenset("dDwWsSbBAzZntrfvhHR")


def _skip_class(pattern: str, i: int) -> int:
    """The place after the character class that opens at ``i``; -1 where it is nested."""
    j = i + 2 if pattern[i + 1 : i + 2] == "^" else i + 1
    j += pattern[j : j + 1] == "]"
    while j < len(pattern) and pattern[j] != "]":
        if pattern[j] in "[&":
            return -1
        j += 2 if pattern[j] == "\\" else 1
    return j + 1 if j < len(pattern) else -1


def _skip_group(pattern: str, i: int) -> int:
    """The place after the group that opens at ``i``; -1 where it is not plain."""
    depth, j = 0, i
    while j < len(pattern):
        c = pattern[j]
        if c == "\\":
            j += 2
            continue
        if c == "[":
            j = _skip_class(pattern, j)
            if j < 0:
                return -1
            continue
        depth += (c == "(") - (c == ")")
        j += 1
        if not depth:
            return j
    return -1


def mandatory_literals(pattern: str | None) -> list[tuple[str, bool]] | None:
    """Per alternative of ``pattern`` the longest literal that each of its matches holds,
    and whether the alternative is that literal and nothing else.

    None where an alternative has no such literal, and for what this reader does not
    know (flags, quotations, code point escapes, nested classes): such a pattern must
    be tried on every text.
    """
    if not pattern or "(?" in pattern and any(pattern[i + 2 : i + 3] not in (":", "=", "!", "<") for i in range(len(pattern)) if pattern.startswith("(?", i)):
        return None
    out: list[tuple[str, bool]] = []
    runs, run, plain, i = [], "", True, 0
    while i <= len(pattern):
        c = pattern[i] if i < len(pattern) else "|"
        if c == "|":
            best = max([*runs, run], key=len)
            if not best:
                return None
            out.append((best, plain))
            runs, run, plain, i = [], "", True, i + 1
            continue
        literal, i = c, i + 1
        if c == "\\":
            escaped = pattern[i : i + 1]
            if not escaped or escaped.isalnum() and escaped not in _CLASSES:
                return None
            literal, i = "" if escaped.isalnum() else escaped, i + 1
        elif c in "[(":
            i = _skip_class(pattern, i - 1) if c == "[" else _skip_group(pattern, i - 1)
            if i < 0:
                return None
            literal = ""
        elif c in ".^$":
            literal = ""
        elif c in "*?+{)":
            return None
        follows = pattern[i : i + 1]
        if follows and follows in "*?+{":
            if follows == "{":
                close = pattern.find("}", i)
                if close < 0:
                    return None
                i = close
            i += 1
            i += pattern[i : i + 1] in ("?", "+") and bool(pattern[i : i + 1])
            runs.append(run + literal if follows == "+" else run)
            run, plain = "", False
        elif literal:
            run += literal
        else:
            runs.append(run)
            run, plain = "", False
    return out
