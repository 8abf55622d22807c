WITH j AS (SELECT p.codcategoria, p.codsec, m.qt FROM pcmov m JOIN pcprodut p ON m.codprod = p.codprod)
SELECT codcategoria, codsec, CAST(SUM(qt) AS DOUBLE) AS qt, 2 AS nivel FROM j GROUP BY codcategoria, codsec
UNION ALL
SELECT codcategoria, NULL, CAST(SUM(qt) AS DOUBLE), 1 FROM j GROUP BY codcategoria
UNION ALL
SELECT NULL, NULL, CAST(SUM(qt) AS DOUBLE), 0 FROM j
