"""wardflow: patient-flow and census analytics as Spark DataFrame jobs."""
