"""consentflow: a Spark-native consent and event analytics mart.

Raw sampled product/consent events plus company, country and calendar
reference data are cleaned, keyed and extrapolated, then rolled up into a
dimensional model (company/country/date dimensions, an event fact, a
company-by-day consent fact and a report table). Everything is expressed with
DataFrame / SQL operators so Catalyst and Tungsten plan the work.
"""

__version__ = "0.1.0"
