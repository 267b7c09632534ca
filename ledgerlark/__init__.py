"""Card-transaction analytics and fraud modelling as Spark DataFrame operators."""
