"""offermart: job-market analytics as Spark DataFrame transformations."""
