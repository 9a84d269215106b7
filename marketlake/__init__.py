"""marketlake: a PySpark-native ingest engine for market-data payloads.

Landed payloads (JSON frames, paged market listings, quarterly statements,
calendar dates, symbol lists) are read as batch or streaming DataFrames,
parsed strictly, projected to typed rows, validated with rejects kept, and
written to keyed tables (append, insert-ignore, upsert) whose contents do not
depend on how the input was partitioned or replayed.

Everything is expressed with DataFrame / SQL expressions; there is no Python
UDF on the data path.
"""

from marketlake.session import get_session, require_utc, scratch_dir

__all__ = ["get_session", "require_utc", "scratch_dir"]
__version__ = "0.1.0"
