"""claimloom: national health-insurance claims to the OMOP CDM v5.3.1, as Spark jobs."""
