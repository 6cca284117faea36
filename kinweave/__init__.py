"""kinweave: similarity families of short sequences, and their analytics, as Spark plans."""
