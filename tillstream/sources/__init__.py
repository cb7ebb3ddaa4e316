"""Sources, sinks and the views that read the test tables as payment events."""
