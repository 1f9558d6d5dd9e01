"""usagetally: usage-log analytics (project facts, user enrichment, history
merges, per-day feature usage) as Spark DataFrame plans.

Subpackages: ``functions`` (column rules), ``operators`` (DataFrame →
DataFrame), ``sources`` (scans, sinks, fixtures), ``plans`` (jobs, batch
window, registered queries), ``streaming`` (file-stream driver of the usage
merge).
"""

__version__ = "0.1.0"
