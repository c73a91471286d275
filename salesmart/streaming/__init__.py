"""No streaming operators.

The modelled system runs once per invocation and stops: it has no streams, event-time
windows, watermarks or state.  "Incremental" there means a re-runnable batch load
(``plans.pipeline.run``), which needs none of Structured Streaming.
"""
