"""shardloom: Spark jobs for large content-addressed asset catalogs."""
