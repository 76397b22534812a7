"""String expressions over URLs, hashes, weakness ids and canonical ids. All run in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sliceforge.schemas import HOSTS

#: str.splitlines() borders: carriage return with line feed, or any single one of these.
LINE_BREAK = "\\r\\n|[\\n\\r\\x0b\\x0c\\x1c-\\x1e\\x85\\u2028\\u2029]"
_ITEM = "'[^']*'|\"[^\"]*\""


def strip(c: Column) -> Column:
    return F.regexp_replace(c, "^\\s+|\\s+$", "")


def first_filled(*cols: Column, default: str | None = None) -> Column:
    """The first value that is neither null nor empty."""
    found = [F.nullif(c, F.lit("")) for c in cols]
    return F.coalesce(*found, F.lit(default)) if default is not None else F.coalesce(*found)


def normalize_repo_url(raw: Column) -> Column:
    """https URL of host, owner and project; null for anything that is not on a known host."""
    u = strip(raw)
    u = F.when(~u.isin("", "None", "null"), u)
    u = F.regexp_replace(u, "/+$", "")
    u = F.regexp_replace(F.regexp_replace(u, "\\.git$", ""), "^http://", "https://")
    low = F.lower(u)
    out = F.lit(None).cast("string")
    for host in reversed(HOSTS):  # the first host of the list wins
        at = F.locate(host, low)
        tail = F.split(F.substring(u, at + len(host), F.length(u)), "/")
        whole = F.concat(F.substring(low, F.lit(1), at + len(host) - 1), tail[0], F.lit("/"), tail[1])
        out = F.when(at > 0, F.when(F.size(tail) >= 2, whole)).otherwise(out)
    return out


def parse_parents(raw: Column) -> Column:
    """Commit hashes of a list literal, or of text that is split at white space; null and empty give none."""
    t = strip(F.coalesce(raw, F.lit("")))
    literal = t.rlike(f"^\\[\\s*((({_ITEM})\\s*,\\s*)*({_ITEM})\\s*,?\\s*)?\\]$")
    items = F.transform(F.regexp_extract_all(t, F.lit(_ITEM), F.lit(0)), lambda x: strip(F.substring(x, F.lit(2), F.length(x) - 2)))
    return F.filter(F.when(literal, items).otherwise(F.split(t, "\\s+")), lambda x: x != "")


def cwe_items(raw: Column) -> Column:
    """Items of a comma list that name a weakness class."""
    items = F.transform(F.split(F.coalesce(raw, F.lit("")), ","), strip)
    return F.filter(items, lambda x: x.startswith("CWE-"))


def normalize_cwe(raw: Column) -> Column:
    u = F.replace(F.upper(strip(raw)), F.lit(" "), F.lit(""))
    return (
        F.when(u.startswith("CWE-"), u)
        .when(u.startswith("CWE"), F.concat(F.lit("CWE-"), F.substring(u, F.lit(4), F.length(u))))
        .when(u.rlike("^[0-9]+$"), F.concat(F.lit("CWE-"), u))
        .otherwise(u)
    )


def is_banned(url: Column, patterns) -> Column:
    """Whether the URL holds one of the patterns, in any case."""
    out = F.lit(False)
    for p in patterns:
        out = out | (F.instr(F.lower(url), p.lower()) > 0)
    return out


def patch_id(url: Column, cve: Column) -> Column:
    return F.concat(F.substring_index(F.regexp_replace(url, "/+$", ""), "/", -1), F.lit("/"), cve)


def below(path: Column, root: str | None) -> Column:
    """A path relative to a folder that it begins with; other paths stay."""
    if not root:
        return path
    prefix = root.rstrip("/") + "/"
    return F.when(F.startswith(path, F.lit(prefix)), F.substring(path, F.lit(len(prefix) + 1), F.length(path))).otherwise(path)


def short_name(full: Column) -> Column:
    return F.substring_index(full, ":", -1)


def canonical_id(pid: Column, version: Column, nth: Column) -> Column:
    return F.format_string("%s:%s:%05d", pid, version, nth)


def sample_of(canonical: Column) -> Column:
    """What stands before the last colon of a canonical id."""
    return F.regexp_extract(canonical, "^(.*):[^:]*$", 1)


def cache_key(repo: Column, commit: Column) -> Column:
    return F.substring(F.sha1(F.concat_ws("::", repo, commit)), 1, 16)


def repo_folder(url: Column) -> Column:
    """Folder name of a repository: no scheme, host dropped where three segments are left, joined by two underscores."""
    t = F.regexp_replace(F.regexp_replace(url, "^[a-z+]+://", ""), "/+$", "")
    t = F.regexp_replace(F.regexp_replace(t, "\\.git$", ""), "^([^:]*):", "$1/")
    parts = F.filter(F.split(t, "/"), lambda x: x != "")
    return F.array_join(F.when(F.size(parts) >= 3, F.slice(parts, F.lit(2), F.size(parts))).otherwise(parts), "__")


def path_safe(c: Column) -> Column:
    return F.replace(c, F.lit("/"), F.lit("__"))


def tail(c: Column, n: int) -> Column:
    return F.right(c, F.lit(n))


def default_patch_id(repo: Column, fix: Column) -> Column:
    return F.concat(repo, F.lit(":"), F.left(fix, F.lit(8)))


def camel(name: str) -> str:
    """SCREAMING_SNAKE to camelCase, for column names."""
    head, *rest = name.lower().split("_")
    return head + "".join(p.capitalize() for p in rest) if name.isupper() else name
