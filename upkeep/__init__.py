"""upkeep -- equipment-maintenance analytics on Spark.

Entry points (all take and return DataFrames; nothing is collected):

* ``plans.refresh.refresh_due``  -- the due-soon refresh as one frame (stage, upsert, purge)
* ``plans.due_store.refresh_store`` / ``read_due``  -- the same at rest: buckets, versions, change-driven days
* ``plans.views``                               -- current components, timeline, month rules due, dashboard views
* ``operators.history``                         -- slot closing and automatic detail lines (batch)
* ``streaming.history_stream``                  -- the same two triggers in Structured Streaming
* ``operators.load`` / ``operators.quality``     -- idempotent loading and integrity checks
* ``sources.testdata.load``                     -- the driver's test tables adapted to the domain tables
"""
