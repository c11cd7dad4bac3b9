"""DataFrame operators: person, concepts, events, pivot, visits, area, attach, explore, joins, checks."""
