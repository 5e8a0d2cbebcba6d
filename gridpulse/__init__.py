"""gridpulse: telemetry analytics for energy plants, written as Spark jobs."""
