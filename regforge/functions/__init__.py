"""Column functions: each maps Column(s) to a Column and stays in the JVM,
except the subsequence scores in :mod:`regforge.functions.subsequence`."""
