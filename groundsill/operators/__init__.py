"""Table jobs: DataFrame in, DataFrame out, no actions unless the docstring says so."""
