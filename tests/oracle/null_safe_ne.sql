SELECT p.codprod, p.codfornec,
       CASE WHEN f.codfornec IS NULL THEN NULL
            WHEN f.classificacao = 'F' THEN 'FARMA' WHEN f.classificacao = 'H' THEN 'HB' ELSE 'OUTROS' END AS classificacao
FROM pcprodut p LEFT JOIN pcfornec f ON p.codfornec = f.codfornec
WHERE (CASE WHEN f.codfornec IS NULL THEN NULL
            WHEN f.classificacao = 'F' THEN 'FARMA' WHEN f.classificacao = 'H' THEN 'HB' ELSE 'OUTROS' END) IS DISTINCT FROM 'OUTROS'
