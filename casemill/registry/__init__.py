"""One registered query per operator and job."""

from . import columns, exports, frames, identity, jobs, quality, volume  # noqa: F401
from .base import all_queries, all_sql  # noqa: F401
