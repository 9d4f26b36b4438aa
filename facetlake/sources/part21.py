"""Exchange files as table functions: one row for each entity instance, or for each tag of a page."""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf

# A quoted string may hold any sign, a doubled quote stands for one, and the two halves of such a string read like two strings.
_INSTANCE = re.compile(r"#(\d+)\s*+=\s*+([A-Za-z][A-Za-z0-9_]*+)?\s*+\(((?:[^';]++|'[^']*+')*+);")
_COMMENT = re.compile(r"('[^']*+')|/\*.*?\*/", re.S)
_TAG = re.compile(r"""<(/?)([A-Za-z][A-Za-z0-9]*+)((?:[^"'<>]++|"[^"]*+"|'[^']*+')*+)>""")


@udtf(returnType="position int, id long, name string, arguments string")
class Instances:
    """``#id = NAME ( arguments ) ;`` by their place in the text; a complex instance has no name. Null and empty texts have no rows."""

    def eval(self, text: str | None) -> Iterator[tuple[int, int, str | None, str]]:
        position = 0
        for m in _INSTANCE.finditer(_COMMENT.sub(lambda m: m[1] or " ", text or "")):
            body = m[3].rstrip()
            if body.endswith(")"):
                position += 1
                yield position, int(m[1]), m[2] and m[2].upper(), body[:-1].strip()


@udtf(returnType="position int, closing boolean, name string, arguments string")
class Tags:
    """Tags of a page by their place in it, names in lower case, arguments as they stand. Null and empty texts have no rows."""

    def eval(self, text: str | None) -> Iterator[tuple[int, bool, str, str]]:
        for position, m in enumerate(_TAG.finditer(text or ""), 1):
            yield position, bool(m[1]), m[2].lower(), m[3]


def instances(files: DataFrame, text: str) -> DataFrame:
    """Rows of ``files`` with each entity instance of their text beside them; files without any have no row."""
    return files.lateralJoin(Instances(F.col(text).outer())).drop(text)


def tags(pages: DataFrame, html: str) -> DataFrame:
    return pages.lateralJoin(Tags(F.col(html).outer())).drop(html)


def references(rows: DataFrame) -> DataFrame:
    """Adds ``refers``: the ids that an instance's arguments name, quoted strings left aside."""
    bare = F.regexp_replace("arguments", "'[^']*'", "")
    return rows.withColumn("refers", F.transform(F.regexp_extract_all(bare, F.lit(r"#(\d+)"), 1), lambda x: x.cast("long")))
