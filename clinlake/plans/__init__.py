"""Model plans: staging, intermediate, marts, reports, metrics, quality, audit."""
