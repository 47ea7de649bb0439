"""Transaction-risk analytics as composable DataFrame functions."""
