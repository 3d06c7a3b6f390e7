"""airloom: schedule integration on Spark DataFrames.

Every public function takes DataFrames and returns DataFrames; plans are
declared with the DataFrame API so that Catalyst chooses the physical strategy.
"""
