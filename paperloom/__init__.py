"""paperloom: build and analyse large corpora of scholarly preprints with PySpark.

Sub-packages
    sources    scans and sinks (XML, CSV, text, archives, tables)
    functions  column expressions
    operators  DataFrame -> DataFrame operators
    models     MLlib topic, word, document and layout models
    plans      end-to-end flows built from the pieces above
    streaming  incremental, exactly-once versions of the flows
"""

from paperloom.session import build_session

__all__ = ["build_session"]
