"""Table operators: DataFrame(s) in, lazy DataFrame out."""
