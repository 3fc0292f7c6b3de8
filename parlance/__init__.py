"""DataFrame analyses for large logs of chat conversations.

Every public function takes and returns Spark DataFrames (or Columns); nothing is
computed until the caller acts on the result, except where a model is fitted or a
short list of quantile cut points is asked for.
"""
