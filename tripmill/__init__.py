"""Trip analytics and fare modelling as Spark DataFrame and Spark ML jobs."""
