"""panelkit: reconcile repeated extractions of tabular reports into an entity x period panel, on Spark."""
