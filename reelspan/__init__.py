"""Robot recordings to training episodes, as Spark plans."""
