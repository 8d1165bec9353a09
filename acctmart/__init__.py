"""Account and customer marts as Spark DataFrame plans."""
