"""Event and traffic impact analytics as PySpark DataFrame operators."""
