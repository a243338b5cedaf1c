"""The bronze, silver and gold jobs of both data sets, and the query catalogue."""
