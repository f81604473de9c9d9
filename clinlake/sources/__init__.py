"""Raw sources, the benchmark binding and table sinks."""
