"""SQL front end: the Postgres-flavoured dialect over Spark SQL, with tables that DML changes."""

from tessera.sql.dialect import translate
from tessera.sql.engine import Engine

__all__ = ["Engine", "translate"]
