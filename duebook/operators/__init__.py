"""Row, group and table operators: DataFrame in, DataFrame out."""
