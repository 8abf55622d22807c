SELECT DISTINCT p.codprod, CAST(e.valorultent AS DOUBLE) AS valorultent, e.codfilial,
       CASE WHEN f.classificacao = 'F' THEN 'FARMA' WHEN f.classificacao = 'H' THEN 'HB' ELSE 'Outros' END AS classificacao
FROM pcprodut p
LEFT JOIN pcfornec f ON p.codfornec = f.codfornec
LEFT JOIN pcest e ON p.codprod = e.codprod
