"""Entity resolution, scoring and marts for business-contact data, as Spark jobs."""
