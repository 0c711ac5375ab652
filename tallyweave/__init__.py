"""tallyweave: tabular analytics on Spark DataFrames.

Every public function takes and returns DataFrames (or Columns); nothing here
pulls rows to the driver beyond fixed-size summaries.
"""
