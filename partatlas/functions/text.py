"""Column functions on names, versions and paths. All stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from partatlas.constants import STORE_ROOT, TOOL_ROOT, WHITESPACE


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body) -> Column:
    """Bind ``value`` once and hand it to ``body`` as a lambda variable.

    Without this, an expression used inside a nested lambda is evaluated again
    for every element.
    """
    return F.transform(F.array(value), body)[0]


def strip(c: Column | str) -> Column:
    """Remove all leading and trailing white space, not only blanks."""
    return F.trim(col(c), F.lit(WHITESPACE))


def folded(c: Column | str) -> Column:
    """The form in which names are compared: stripped and in lower case."""
    return F.lower(strip(c))


def version_key(c: Column | str) -> Column:
    """Dotted version as ARRAY<BIGINT>; a piece that is no integer counts -1.

    Arrays compare element by element with the shorter one first.
    """
    return F.transform(
        F.split(col(c), r"\."),
        lambda piece: F.coalesce(strip(piece).try_cast("bigint"), F.lit(-1).cast("bigint")),
    )


def basename(c: Column | str) -> Column:
    """Last piece of a path, ignoring a trailing slash."""
    return F.element_at(F.split(F.regexp_replace(col(c), r"/+\z", ""), "/"), -1)


def slug(c: Column | str) -> Column:
    """File-name-safe form of a query; ``query`` if nothing is left."""
    safe = F.regexp_replace(strip(c), r"[^A-Za-z0-9._-]+", "_")
    return F.coalesce(F.nullif(safe, F.lit("")), F.lit("query"))


def human_bytes(c: Column | str) -> Column:
    """Byte count with one decimal in steps of 1024, ties rounded to even."""
    value = col(c).cast("double")
    steps = [(power, unit) for power, unit in enumerate(("B", "KB", "MB", "GB", "TB"))]
    out = None
    for power, unit in steps:
        hit = value < F.lit(float(1024 ** (power + 1)))
        text = F.format_string(f"%.1f {unit}", F.bround(value / float(1024**power), 1))
        out = F.when(hit, text) if out is None else out.when(hit, text)
    return out.otherwise(F.format_string("%.1f PB", F.bround(value / float(1024**5), 1)))


def normalize_member(c: Column | str) -> Column:
    """Archive member path as STRUCT<path, unsafe>, rooted at the store root.

    Back slashes count as slashes, empty and ``.`` pieces vanish, everything
    before the first store root is cut, else a leading tool root is dropped.
    A ``..`` that is still there makes the member unsafe; so does a path with
    exactly two leading slashes, which stays absolute. ``path`` is NULL if
    nothing is left or the member is unsafe.
    """
    unified = F.regexp_replace(col(c), r"\\", "/")
    pieces = F.filter(F.split(unified, "/"), lambda p: (p != "") & (p != "."))

    def rooted(p: Column) -> Column:
        at = F.array_position(p, STORE_ROOT).cast("int")
        cut = F.when(at > 0, F.slice(p, at, F.greatest(F.size(p), F.lit(1)))).when(
            F.try_element_at(p, F.lit(1)) == TOOL_ROOT,
            F.filter(p, lambda _, i: i > 0),
        ).otherwise(p)
        return let(
            cut,
            lambda q: F.when(F.size(q) == 0, q)
            .when(F.element_at(q, 1) == STORE_ROOT, q)
            .otherwise(F.concat(F.array(F.lit(STORE_ROOT)), q)),
        )

    absolute = unified.rlike(r"^//[^/]") & ~F.array_contains(pieces, STORE_ROOT)
    return let(
        let(pieces, rooted),
        lambda r: let(
            F.array_contains(r, "..") | absolute,
            lambda bad: F.struct(
                F.when(~bad & (F.size(r) > 0), F.array_join(r, "/")).alias("path"),
                bad.alias("unsafe"),
            ),
        ),
    )


def _glob_class(body: str) -> str:
    """Content of a bracket as a Java class; ranges that run backwards are empty."""
    negate, body = body.startswith("!"), body.removeprefix("!")
    out, i = [], 0
    while i < len(body):
        if body[i + 1 : i + 2] == "-" and i + 2 < len(body):
            low, high = body[i], body[i + 2]
            if low <= high:
                out.append(f"{_quoted(low)}-{_quoted(high)}")
            i += 3
        else:
            out.append(_quoted(body[i]))
            i += 1
    if not out:
        return "." if negate else "(?!)"
    return f"[{'^' if negate else ''}{''.join(out)}]"


def _quoted(ch: str) -> str:
    return ch if ch.isalnum() or ch in "_/ \n" else "\\" + ch


def glob_to_regex(glob: str) -> str:
    """Shell glob as an anchored Java regular expression; ``*`` crosses ``/``."""
    out, i = [], 0
    while i < len(glob):
        ch = glob[i]
        # A bracket right after the opening one (or its !) is a member.
        end = glob.find("]", i + 2 + glob.startswith("!", i + 1)) if ch == "[" else -1
        if ch == "*":
            out.append(".*")
        elif ch == "?":
            out.append(".")
        elif end > 0:
            out.append(_glob_class(glob[i + 1 : end]))
            i = end
        else:
            out.append(_quoted(ch))
        i += 1
    return rf"(?s)\A(?:{''.join(out)})\z"


def glob_match(c: Column | str, globs: list[str]) -> Column:
    """True if any of the globs matches."""
    hits = [col(c).rlike(glob_to_regex(g)) for g in globs]
    out = hits[0]
    for hit in hits[1:]:
        out = out | hit
    return out
