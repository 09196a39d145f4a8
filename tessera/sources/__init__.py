"""Scans and sinks: headerless CSV (inferred or fixed schema), text lines,
category-link lines, small result sinks.  Paths for intermediate files come
from the shared folder (``tessera.session.scratch_path``)."""

from tessera.sources.files import (  # noqa: F401
    read_csv_inferred, read_csv_schema, read_text, write_text, write_csv,
    write_small_result, parse_links, doc_lines,
)
