"""Registered queries of the quantification engine and their SQL."""

from . import binary, cells, files, flagship, wide

FLAGSHIP = flagship.counts
QUERIES: dict = {**flagship.QUERIES, **wide.Q, **files.Q, **binary.Q, **cells.Q}
ORACLE_SQL: dict = {**flagship.ORACLE_SQL, **wide.O, **files.O, **binary.O, **cells.O}
