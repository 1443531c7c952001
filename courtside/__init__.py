"""Match statistics over play-by-play feeds, as Spark DataFrame operators."""
