"""Column-level building blocks: the routing hash and the text analyser."""
