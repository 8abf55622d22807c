SELECT codprod, codfilial, estoquepordtvalidadepk
FROM (SELECT *, row_number() OVER (PARTITION BY codprod ORDER BY codfilial, estoquepordtvalidadepk) AS rn FROM pcprodfilial)
WHERE rn = 1
