"""Job-posting analytics as plain PySpark DataFrame and Column functions."""
