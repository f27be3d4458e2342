"""rivulet: change-log analytics on Spark, declared as DataFrame plans."""
