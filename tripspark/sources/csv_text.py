"""CSV files that give back every value they were written from.

Every value is quoted, a quote inside is doubled, line ends are escaped, and a NULL is the mark
``NULL_MARK`` while an empty text is empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import col, lit
from pyspark.sql.types import StringType

NULL_MARK = "\\N"

_FORMAT = {
    "header": "true",
    "escape": '"',
    "nullValue": NULL_MARK,
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
}


def _writable(name: str, value: Column) -> Column:
    """A text that equals the mark would come back as NULL, so it stops the export."""
    problem = F.raise_error(lit(f"column {name} holds the text that marks NULL in CSV"))
    return F.when(value == NULL_MARK, problem).otherwise(value).alias(name)


# Line ends inside values are written as two characters, so that a line of the file is a row and
# any file can be divided among tasks. The first of them is written as two as well.
ESCAPE = "\x1b"
# NUL, which the parser drops at the end of a line, is treated alike.
_CODES = {ESCAPE: f"{ESCAPE}e", "\n": f"{ESCAPE}n", "\r": f"{ESCAPE}r", "\0": f"{ESCAPE}0"}
# A file of this name says that a folder was written so.
MARK = "_line_ends_are_escaped"


def _escaped(value: Column) -> Column:
    for plain, code in _CODES.items():
        value = F.replace(value, lit(plain), lit(code))
    return value


def _unescaped(value: Column) -> Column:
    for plain, code in reversed(_CODES.items()):
        value = F.replace(value, lit(code), lit(plain))
    return value


def _mark(spark: SparkSession, path: str) -> tuple:
    """The file system and the name of the mark of a folder."""
    mark = spark._jvm.org.apache.hadoop.fs.Path(path, MARK)
    return mark.getFileSystem(spark._jsc.hadoopConfiguration()), mark


def write_csv(df: DataFrame, path: str) -> None:
    columns = []
    for f in df.schema.fields:
        name = f.name
        for plain, code in _CODES.items():
            name = name.replace(plain, code)
        value = col(f"`{f.name.replace('`', '``')}`")
        if isinstance(f.dataType, StringType):
            value = _escaped(_writable(f.name, value))
        columns.append(value.alias(name))
    df.select(*columns).write.mode("overwrite").options(**_FORMAT, quoteAll="true").csv(path)
    files, mark = _mark(df.sparkSession, path)
    files.create(mark, True).close()


def read_csv_strings(spark: SparkSession, path: str) -> DataFrame:
    """A CSV with a header, every column as text.

    A folder of ``write_csv`` is read in pieces of any file. Elsewhere quoted values may hold line
    ends, so a file is read by one task.
    """
    files, mark = _mark(spark, path)
    if not files.exists(mark):
        return spark.read.options(**_FORMAT, multiLine="true").csv(path)
    texts = spark.read.options(**_FORMAT).csv(path)
    columns = []
    for name in texts.columns:
        plain_name = name
        for plain, code in reversed(_CODES.items()):
            plain_name = plain_name.replace(code, plain)
        columns.append(_unescaped(col(f"`{name.replace('`', '``')}`")).alias(plain_name))
    return texts.select(*columns)
