"""Code lists, cascading choices and field-record merging as Spark DataFrame operators."""
