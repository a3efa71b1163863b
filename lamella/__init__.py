"""lamella: labelled-volume analytics and corpus preparation on Spark."""
